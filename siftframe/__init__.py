"""Search, analytics and bulk writes over document tables, as Spark plans."""

from siftframe.plans.collection import Collection
from siftframe.sources.mapping import Field, Mapping

__all__ = ["Collection", "Field", "Mapping"]
