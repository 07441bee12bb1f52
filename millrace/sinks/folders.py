"""Small files and folders of any store that Spark reaches, from the driver."""


class Folder:
    """A folder's file system and the paths below it."""

    def __init__(self, spark, root):
        self.root = root.rstrip("/")
        self._spark = spark
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name):
        return self._fs.exists(self._path(name))

    def names(self, name):
        """Names in a folder; none if there is no such folder."""
        path = self._path(name)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def matching(self, pattern):
        """Paths below the root that match a pattern."""
        found = self._fs.globStatus(self._path(pattern)) or []
        base = len(self._fs.makeQualified(self._path("")).toUri().getPath()) + 1
        return sorted(s.getPath().toUri().getPath()[base:] for s in found)

    def read(self, name):
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name, text=""):
        """Write a file, replacing one of that name."""
        stream = self._fs.create(self._path(name), True)
        try:
            stream.write(text.encode())
        finally:
            stream.close()

    def move(self, name, to):
        """Rename a file; fails if the target is there."""
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path("").toUri(), self._conf)
        kind = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        qualified = [self._fs.makeQualified(self._path(n)) for n in (name, to)]
        context.rename(*qualified, self._spark.sparkContext._gateway.new_array(kind, 0))

    def delete(self, name):
        self._fs.delete(self._path(name), True)
