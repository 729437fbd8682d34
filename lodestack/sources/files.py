"""Files of the table store, through Hadoop's file systems."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class AlreadyThere(RuntimeError):
    """A file that was to be new exists."""


class Files:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.jvm = spark, spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, text: str):
        return self.jvm.org.apache.hadoop.fs.Path(text)

    def names(self, folder: str) -> list[str]:
        if not self.fs.exists(self.path(folder)):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(self.path(folder))]

    def read_text(self, file: str) -> str:
        stream = self.fs.open(self.path(file))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def read_json(self, file: str) -> dict:
        return json.loads(self.read_text(file))

    def write_text(self, file: str, text: str) -> None:
        stream = self.fs.create(self.path(file), False)
        stream.write(bytearray(text.encode()))
        stream.close()

    def write_json(self, file: str, value: dict) -> None:
        self.write_text(file, json.dumps(value, default=str))

    def put_new(self, file: str, value: dict) -> None:
        """Write a file whole, in one rename; raises AlreadyThere if there is one."""
        folder = file.rpartition("/")[0]
        staged = f"{folder}/.{uuid.uuid4().hex}"
        self.write_json(staged, value)
        source = self.path(staged)
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        none = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(source, self.path(file), none)
        except Exception as error:
            self.fs.delete(source, False)
            if "FileAlreadyExists" in str(error):
                raise AlreadyThere(file) from error
            raise

    def sizes(self, folder: str) -> dict[str, int]:
        """Bytes of all Parquet files below a folder, by their path from there."""
        out, prefix = {}, None
        if not self.fs.exists(self.path(folder)):
            return out
        prefix = self.fs.getFileStatus(self.path(folder)).getPath().toString() + "/"
        found = self.fs.listFiles(self.path(folder), True)
        while found.hasNext():
            status = found.next()
            name = status.getPath().toString()
            if name.endswith(".parquet"):
                out[name.removeprefix(prefix)] = status.getLen()
        return out

    def delete(self, path: str) -> None:
        self.fs.delete(self.path(path), True)
