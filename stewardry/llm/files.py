"""Files that tasks write to and read from the shared folder."""

import os
import uuid

from pyarrow import fs


def open_store(path):
    """The file system of a URI or an absolute path, and the path in it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def new_file(folder, name):
    """A path no other attempt of the task writes to.

    Readers follow the manifest of the attempts that Spark accepted, so what a lost
    or repeated attempt left behind is never read.
    """
    store, root = open_store(folder)
    store.create_dir(root, recursive=True)
    return os.path.join(folder, f"{name}-{uuid.uuid4().hex}")


def writer(path):
    store, inner = open_store(path)
    return store.open_output_stream(inner)


def reader(path):
    store, inner = open_store(path)
    return store.open_input_file(inner)
