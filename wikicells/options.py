"""Choices shared by all operators."""

#: Results as the original tool gives them.
OBSERVED = "observed"
#: Results as the rules of wikitext have them.
INTENDED = "intended"


def check_dialect(dialect: str) -> None:
    if dialect not in (OBSERVED, INTENDED):
        raise ValueError(f"dialect must be {OBSERVED!r} or {INTENDED!r}, not {dialect!r}")
