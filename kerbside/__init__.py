"""Fleet mobility analytics for shared vehicles, written as Spark DataFrame plans."""

from kerbside.session import configure

__all__ = ["configure"]
