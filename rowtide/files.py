"""Files beside Spark's own: those that tasks write one by one, and small ones that appear as a whole."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow.fs as pafs


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and the folder's path in it; a plain path is a local or mounted one."""
    return pafs.FileSystem.from_uri(uri if uri.startswith("file:") or "://" in uri else Path(uri).absolute().as_uri())


@contextmanager
def new_file(uri: str) -> Iterator:
    """A stream to a file that gets its name when all is written; a failed task leaves no such name."""
    files, path = file_system(uri)
    files.create_dir(path.rpartition("/")[0], recursive=True)
    part = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}.tmp"
    with files.open_output_stream(part, compression=None) as out:
        yield out
    files.move(part, path)


def names_in(uri: str) -> list[str]:
    """The names in a folder, none if it is not there; those of unfinished files are left out."""
    files, path = file_system(uri)
    found = files.get_file_info(pafs.FileSelector(path, allow_not_found=True))
    return sorted(f.base_name for f in found if not f.base_name.startswith((".", "_")))


def read_text(uri: str) -> str:
    files, path = file_system(uri)
    with files.open_input_file(path) as source:
        return source.read().decode()


def write_text(uri: str, text: str) -> None:
    with new_file(uri) as out:
        out.write(text.encode())
