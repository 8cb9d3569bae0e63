"""Files that tasks write and read themselves, below a shared folder named by
a URI or path (any store that ``pyarrow.fs`` can open)."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs as pafs


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:/"):
        return pafs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    return pafs.LocalFileSystem(), path


def make_folder(path: str) -> None:
    store, inner = _store(path)
    store.create_dir(inner, recursive=True)


def list_files(path: str, ending: str) -> list[str]:
    """Full paths of the folder's files with this ending, in name order."""
    store, inner = _store(path)
    found = store.get_file_info(pafs.FileSelector(inner, allow_not_found=True))
    names = sorted(f.base_name for f in found if f.is_file and f.base_name.endswith(ending))
    return [f"{path.rstrip('/')}/{n}" for n in names]


@contextmanager
def written(path: str) -> Iterator:
    """A new file that gets its name when it is complete: a task that is lost
    or run twice leaves no partial file under that name."""
    store, inner = _store(path)
    folder, _, name = inner.rpartition("/")
    part = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as out:
        yield out
    store.move(part, inner)


def remove(path: str) -> None:
    store, inner = _store(path)
    store.delete_file(inner)


def opened(path: str):
    """A seekable file."""
    store, inner = _store(path)
    return store.open_input_file(inner)


def move(source: str, target: str) -> None:
    store, a = _store(source)
    store.move(a, _store(target)[1])


def remove_folder(path: str) -> None:
    store, inner = _store(path)
    if store.get_file_info(inner).type != pafs.FileType.NotFound:
        store.delete_dir(inner)
