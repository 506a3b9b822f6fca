"""The few file operations beside reading and writing frames, on whatever filesystem the path names."""

from pyspark.sql import SparkSession


class Folder:
    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._io = spark._jvm.org.apache.commons.io.IOUtils

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def _at(self, *parts: str):
        return self._path(self.path(*parts))

    def modified(self, pattern: str) -> dict[str, int]:
        """Matching paths, relative to the root, in name order, with the time of their last change in ms."""
        found = self._fs.globStatus(self._at(pattern)) or []
        depth = pattern.count("/") + 1
        times = {
            "/".join(status.getPath().toString().split("/")[-depth:]): status.getModificationTime()
            for status in found
        }
        return dict(sorted(times.items()))

    def glob(self, pattern: str) -> list[str]:
        return list(self.modified(pattern))

    def read_text(self, *parts: str) -> str:
        stream = self._fs.open(self._at(*parts))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, text: str, *parts: str) -> None:
        """The file appears under its name only when it is complete."""
        target, draft = self._at(*parts), self._at(*parts[:-1], f"_{parts[-1]}.draft")
        stream = self._fs.create(draft, True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        if not self._fs.rename(draft, target):
            raise OSError(f"could not publish {target.toString()}")

    def replace_text(self, text: str, *parts: str) -> None:
        """Like write_text, also where the file exists."""
        self.remove(*parts)
        self.write_text(text, *parts)

    def remove(self, *parts: str) -> None:
        self._fs.delete(self._at(*parts), True)
