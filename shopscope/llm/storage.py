"""Files that tasks write to and read from storage all executors share.

A task writes under names no other attempt uses and returns them as rows; only names that a
successful attempt has returned are read, so a lost or repeated task leaves nothing but litter.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), uri.removeprefix("file:").replace("///", "/").replace("//", "/")
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1).replace("s3n://", "s3://", 1))


class Output:
    """A new file below a folder, with a name of its own."""

    def __init__(self, folder: str, suffix: str):
        self.uri = f"{folder.rstrip('/')}/{uuid.uuid4().hex}{suffix}"
        system, path = opened(self.uri)
        if isinstance(system, fs.LocalFileSystem):
            system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.stream = system.open_output_stream(path, compression=None)
        self.size = 0

    def write(self, data: bytes) -> int:
        """Append; returns where the data begin."""
        at = self.size
        self.stream.write(data)
        self.size += len(data)
        return at

    def close(self) -> None:
        self.stream.close()


def reader(uri: str):
    """A seekable file."""
    system, path = opened(uri)
    return system.open_input_file(path)
