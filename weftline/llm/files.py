"""Files that tasks write and read in the shared folder, by URI."""

from __future__ import annotations

import os
import uuid


def at(uri: str):
    """(filesystem, path) of a URI or of a plain path."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


class Committed:
    """A file that appears under its name only when it is complete.

    It is written under a temporary name of its own. Attempts of one task write
    the same bytes, so it doesn't matter which of them is renamed last.
    """

    def __init__(self, folder: str, name: str) -> None:
        self.fs, path = at(folder)
        self.final, self.temp = f"{path}/{name}", f"{path}/_temporary/{name}.{os.getpid()}-{uuid.uuid4().hex}"
        self.fs.create_dir(f"{path}/_temporary", recursive=True)
        self.stream = self.fs.open_output_stream(self.temp, compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def commit(self) -> None:
        from pyarrow import fs

        self.stream.close()
        try:
            self.fs.move(self.temp, self.final)
        except OSError:
            if self.fs.get_file_info(self.final).type == fs.FileType.NotFound:
                raise
            self.fs.delete_file(self.final)
            self.fs.move(self.temp, self.final)


class Window:
    """Reads ranges of a file, mostly in ascending order, through one bounded buffer."""

    AHEAD = 4 << 20

    def __init__(self, folder: str, name: str, ahead: int = AHEAD) -> None:
        filesystem, path = at(folder)
        self.file, self.ahead = filesystem.open_input_file(f"{path}/{name}"), ahead
        self.start, self.data = 0, b""

    def read(self, start: int, size: int) -> bytes:
        if start < self.start or start + size > self.start + len(self.data):
            self.file.seek(start)
            self.start, self.data = start, self.file.read(max(size, self.ahead))
        return self.data[start - self.start : start - self.start + size]
