"""Files in a folder that driver and executors share, by its URI."""

import uuid

from pyarrow import fs


def open_folder(folder):
    """(file system, path in it) of a folder's URI or absolute path."""
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") \
        else (fs.LocalFileSystem(), folder)


class Files:
    """Writer of new files. Each attempt of a task writes under names of its own; only the files named in
    the rows that a finished task returns count, so a repeated or lost attempt does no harm."""

    def __init__(self, folder, suffix):
        self.store, self.path = open_folder(folder)
        self.suffix = suffix
        self.store.create_dir(self.path, recursive=True)

    def write(self, payload):
        name = f"{uuid.uuid4().hex}{self.suffix}"
        with self.store.open_output_stream(f"{self.path}/{name}", compression=None) as out:  # as given, whatever the name
            out.write(payload)
        return name


def open_file(folder, name):
    store, path = open_folder(folder)
    return store.open_input_file(f"{path}/{name}")
