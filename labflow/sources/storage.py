"""Folder operations through the Hadoop file system the session is configured for."""


class Folder:
    """A path and its file system; works for any scheme the cluster can reach."""

    def __init__(self, spark, path, parent=None):
        self.spark = spark
        # Looking the class up costs several calls, so children share it.
        self.to_path = parent.to_path if parent else spark._jvm.org.apache.hadoop.fs.Path
        if parent:
            self.fs, self.path = parent.fs, self.to_path(parent.path, path)
        else:
            raw = self.to_path(path)
            self.fs = raw.getFileSystem(spark._jsc.hadoopConfiguration())
            self.path = self.fs.makeQualified(raw)

    def __str__(self):
        return self.path.toString()

    def child(self, name):
        return Folder(self.spark, name, self)

    def exists(self):
        return self.fs.exists(self.path)

    def names(self):
        """Names of the direct children; empty if the folder is absent."""
        if not self.exists():
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path))

    def delete(self):
        return self.fs.delete(self.path, True)

    def mark(self):
        """Create an empty file here."""
        self.fs.create(self.path, True).close()


def has_files(spark, path):
    """Whether a folder holds anything a scan would see; looks no further than the first such entry."""
    folder = Folder(spark, path)
    if not folder.exists():
        return False
    entries = folder.fs.listStatusIterator(folder.path)
    while entries.hasNext():
        if not entries.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


def subfolders(folder, patterns):
    """Folders whose names match ``patterns``, one a level, with the names that lead to them."""
    if not patterns:
        return [((), folder)]
    found = []
    for name in folder.names():
        if patterns[0].fullmatch(name):
            found += [((name, *rest), leaf) for rest, leaf in subfolders(folder.child(name), patterns[1:])]
    return found
