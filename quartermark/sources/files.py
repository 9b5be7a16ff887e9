"""Opening single files inside tasks, on any file system Spark can list."""

from __future__ import annotations

import io
from urllib.parse import quote

from pyarrow import fs

BUFFER = 1024 * 1024


def resolve(path: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path for a path as a Spark file listing shows it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        path = path.replace("s3a://", "s3://", 1)
        return fs.FileSystem.from_uri(quote(path, safe=":/@?=&%+,;~"))
    return fs.LocalFileSystem(), path


def copy_stream(source, path: str, attempt: str) -> None:
    """Writes a stream to a path. The file gets its name when it is whole, so a lost task leaves no part of one."""
    system, inner = resolve(path)
    system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    draft = f"{inner}.{attempt}.draft"
    try:
        with system.open_output_stream(draft) as out:
            while data := source.read(BUFFER):
                out.write(data)
        system.move(draft, inner)
    except BaseException:
        if system.get_file_info(draft).type != fs.FileType.NotFound:
            system.delete_file(draft)
        raise


def open_stream(path: str) -> io.BufferedReader:
    """A seekable file object; only what is read is fetched."""
    system, inner = resolve(path)
    return io.BufferedReader(system.open_input_file(inner), BUFFER)
