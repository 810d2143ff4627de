"""Objects in any store that Hadoop reaches: get, put, exists, copy, by URI. For the driver's small files."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Schemes of stores that have no rename in place, and show an object when it is whole.
OBJECT_STORES = frozenset("s3 s3a s3n gs abfs abfss wasb wasbs oss cosn obs".split())


class Blobs:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.jvm, self.conf, self.root = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), root.rstrip("/")

    def uri(self, key: str) -> str:
        return key if "://" in key else f"{self.root}/{key}"

    def _at(self, key: str):
        path = self.jvm.org.apache.hadoop.fs.Path(self.uri(key))
        return path.getFileSystem(self.conf), path

    def exists(self, key: str) -> bool:
        fs, path = self._at(key)
        return fs.exists(path)

    def get(self, key: str) -> bytes | None:
        """The object's bytes, or None if there is none."""
        fs, path = self._at(key)
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def put(self, key: str, body: bytes) -> str:
        """Replaces the object as a whole: readers see the old or the new one. Where two writers meet, the later one's object stays."""
        self._written(key, body, True)
        return self.uri(key)

    def put_new(self, key: str, body: bytes) -> bool:
        """Writes the object unless there is one; whether it did. Of two writers one succeeds, as far as the store's rename or create tells."""
        return not self.exists(key) and self._written(key, body, False)

    def names(self, key: str) -> list[str]:
        """The names of the objects in a folder, sorted; none if there is no such folder."""
        fs, path = self._at(key)
        return sorted(x.getPath().getName() for x in fs.listStatus(path)) if fs.exists(path) else []

    def _written(self, key: str, body: bytes, over: bool) -> bool:
        fs, path = self._at(key)
        hadoop = self.jvm.org.apache.hadoop.fs
        whole_objects = fs.getScheme() in OBJECT_STORES  # an object appears when its stream is closed
        beside = path if whole_objects else hadoop.Path(f"{self.uri(key)}.{uuid.uuid4().hex}.tmp")
        stream = fs.create(beside, over or not whole_objects)
        try:
            stream.write(bytearray(body))
        finally:
            stream.close()
        if whole_objects:
            return True
        how = self.spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
        how[0] = hadoop.Options.Rename.OVERWRITE if over else hadoop.Options.Rename.NONE
        try:
            hadoop.FileContext.getFileContext(path.toUri(), self.conf).rename(beside, path, how)
        except Py4JJavaError as e:
            fs.delete(beside, False)
            if over or "FileAlreadyExistsException" not in str(e.java_exception):
                raise
            return False
        return True

    def delete(self, key: str) -> None:
        """Deletes the object, or the folder with all in it; one that isn't there is no error."""
        fs, path = self._at(key)
        fs.delete(path, True)

    def copy(self, key: str, other: Blobs, other_key: str) -> None:
        a, source = self._at(key)
        b, target = other._at(other_key)
        self.jvm.org.apache.hadoop.fs.FileUtil.copy(a, source, b, target, False, True, self.conf)
