"""Files that tasks write to and read from the shared folder."""

from __future__ import annotations

import posixpath

import numpy as np
from pyspark import TaskContext


def store(uri: str):
    """File system and path of a shared folder, for tasks."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


class Writer:
    """A file in the shared folder that gets its name when it is whole."""

    def __init__(self, folder: str, name: str):
        self.files, base = store(folder)
        self.path, self.uri = posixpath.join(base, name), posixpath.join(folder, name)
        self.files.create_dir(base, recursive=True)
        self.draft = f"{self.path}.{TaskContext.get().taskAttemptId()}.draft"
        self.out = self.files.open_output_stream(self.draft, compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> str:
        self.out.close()
        self.files.move(self.draft, self.path)
        return self.uri


def array_at(uri: str, kind: str) -> np.ndarray:
    """A file of numbers, memory-mapped where the shared folder is a mounted one, else read."""
    from pyarrow import fs

    files, path = store(uri)
    if not files.get_file_info(path).size:
        return np.empty(0, kind)
    if isinstance(files, fs.LocalFileSystem):
        return np.memmap(path, kind, "r")
    with files.open_input_file(path) as source:
        return np.frombuffer(source.read(), kind)
