"""Column expressions: everything here returns a ``Column`` and runs inside codegen."""

from opinio.functions import ratings, recs, sentiment, text

__all__ = ["ratings", "recs", "sentiment", "text"]
