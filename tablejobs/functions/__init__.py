"""Column expressions (all built-in, JVM-side, inside whole-stage codegen)."""

from tablejobs.functions.columns import fahrenheit_to_celsius, to_celsius, date_parts

__all__ = ["fahrenheit_to_celsius", "to_celsius", "date_parts"]
