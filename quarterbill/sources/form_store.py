"""Forms as they arrive: a folder of batches, of which a reader can take the newer ones."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quarterbill.sources.forms import Forms
from quarterbill.sources.publish import _listed, _path
from quarterbill.sources.schemas import FORMS

DONE = "_COMMITTED"


class FormStore:
    """Batches of the four forms under one folder; a batch counts once all four are written."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark = spark
        self._folder = folder

    def _batch(self, number: int) -> str:
        return f"{self._folder}/batch={number:06d}"

    def batches(self) -> list[int]:
        """The numbers of the batches, oldest first."""
        found = []
        for status in _listed(self._spark, self._folder):
            done, system = _path(self._spark, f"{status.getPath()}/{DONE}")
            if system.exists(done):
                found.append(int(status.getPath().getName().split("=")[1]))
        return sorted(found)

    def append(self, forms: Forms) -> int:
        """Write the next batch and return its number."""
        names = [s.getPath().getName() for s in _listed(self._spark, self._folder)]
        number = max((int(n.split("=")[1]) for n in names), default=0) + 1
        for name in FORMS:
            getattr(forms, name).write.parquet(f"{self._batch(number)}/{name}")
        done, system = _path(self._spark, f"{self._batch(number)}/{DONE}")
        system.create(done, False).close()
        return number

    def forms(self, after: int = 0, upto: int | None = None) -> Forms:
        """The forms of all batches, or of those after one and up to another."""
        numbers = [n for n in self.batches() if n > after and (upto is None or n <= upto)]
        return Forms(**{name: self._form(name, numbers) for name in FORMS})

    def _form(self, name: str, numbers: list[int]) -> DataFrame:
        if not numbers:
            return self._spark.createDataFrame([], T.StructType([T.StructField(f.name, f.type) for f in FORMS[name]]))
        parts = [self._spark.read.parquet(f"{self._batch(n)}/{name}") for n in numbers]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
