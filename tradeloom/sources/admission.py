"""How much of a waiting backlog a micro-batch takes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.streaming import DataStreamReader


@dataclass(frozen=True)
class Admission:
    """Bounds of a micro-batch, at every hop; everything by default.

    ``size`` is a number of bytes or a text such as ``10g``; at least one file is taken.
    """

    files: int | None = None
    size: str | int | None = None

    def on(self, reader: DataStreamReader) -> DataStreamReader:
        if self.files and self.size:
            raise ValueError("bound a micro-batch by files or by size")
        if self.files:
            return reader.option("maxFilesPerTrigger", self.files)
        return reader.option("maxBytesPerTrigger", self.size) if self.size else reader


EVERYTHING = Admission()
