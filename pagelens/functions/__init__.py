"""Column -> Column expressions."""

from pagelens.functions import html, text, urls  # noqa: F401
