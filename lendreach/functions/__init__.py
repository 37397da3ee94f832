"""Column functions; all run inside code generation, none calls Python per row."""

from lendreach.functions import dates, flags, money, text  # noqa: F401
