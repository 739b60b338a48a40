"""mailspark: support mail to question/answer rows, as Spark DataFrame operators."""

from mailspark.session import configure

__all__ = ["configure"]
