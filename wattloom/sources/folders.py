"""Names, small texts and removal in any store that Spark reads, by its Hadoop file system."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folders:
    """Driver-side bookkeeping only: no data goes through it."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        place = self._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self._conf), place

    def exists(self, path: str) -> bool:
        fs, place = self._at(path)
        return fs.exists(place)

    def is_folder(self, path: str) -> bool:
        fs, place = self._at(path)
        return fs.exists(place) and fs.getFileStatus(place).isDirectory()

    def names(self, path: str) -> list[str]:
        """Names inside a folder, in order; none if there is no such folder."""
        fs, place = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []

    def read_text(self, path: str) -> str:
        fs, place = self._at(path)
        stream = fs.open(place)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create_text(self, path: str, text: str) -> None:
        """A new file; an error if there is one already."""
        fs, place = self._at(path)
        try:
            stream = fs.create(place, False)
        except Py4JJavaError as error:
            raise FileExistsError(path) from error
        stream.write(bytearray(text.encode()))
        stream.close()

    def make(self, path: str) -> None:
        """A folder, with those above it."""
        fs, place = self._at(path)
        fs.mkdirs(place)

    def move(self, source: str, target: str) -> None:
        """A folder under another name, at once where the store can rename; an error if there is one already."""
        fs, place = self._at(source)
        self.make(target.rsplit("/", 1)[0])
        if fs.exists(self._at(target)[1]) or not fs.rename(place, self._at(target)[1]):
            raise FileExistsError(target)

    def remove(self, path: str) -> None:
        fs, place = self._at(path)
        fs.delete(place, True)
