"""Files that tasks write and read in the shared folder.

Each file is written under a name of its own and then moved to its final name,
which depends on the data alone, so a task that runs again or twice leaves the
same file.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyarrow import fs


def at(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path.replace("file:///", "/", 1))


def make_folder(path: str) -> str:
    where, name = at(path)
    where.create_dir(name, recursive=True)
    return path


@contextmanager
def writing(path: str):
    where, name = at(path)
    own = f"{name}.{uuid.uuid4().hex}.part"
    with where.open_output_stream(own, compression=None) as out:
        yield out
    where.move(own, name)


def reading(path: str):
    where, name = at(path)
    return where.open_input_stream(name, compression=None)


def size(path: str) -> int:
    """Bytes of a file; -1 if there is none."""
    where, name = at(path)
    info = where.get_file_info(name)
    return info.size if info.type == fs.FileType.File else -1
