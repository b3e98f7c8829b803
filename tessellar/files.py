"""Files of a shared store by name, from tasks and from the driver alike: local paths, and whatever file system the name's scheme stands for."""

from __future__ import annotations

import uuid
from posixpath import dirname

from pyarrow import fs as _fs


def store_of(name: str) -> tuple[_fs.FileSystem, str]:
    """The file system of a name, and the name inside it."""
    if "://" in name or name.startswith("file:/"):
        scheme, _, rest = name.partition(":")
        return (_fs.LocalFileSystem(), "/" + rest.lstrip("/")) if scheme == "file" else _fs.FileSystem.from_uri(name)
    return _fs.LocalFileSystem(), name


def exists(name: str) -> bool:
    fs, path = store_of(name)
    return fs.get_file_info(path).type != _fs.FileType.NotFound


def put(name: str, content: bytes) -> None:
    """Write a file whole: beside its place and then moved, so that a lost or repeated task leaves no part of it."""
    fs, path = store_of(name)
    fs.create_dir(dirname(path), recursive=True)
    beside = f"{path}.{uuid.uuid4().hex}.part"
    with fs.open_output_stream(beside, compression=None) as f:
        f.write(content)
    fs.move(beside, path)


def get(name: str) -> bytes:
    fs, path = store_of(name)
    with fs.open_input_stream(path, compression=None) as f:
        return f.read()


def names(folder: str) -> list[str]:
    """Names of the files in a folder, in order; none if there is no such folder."""
    fs, path = store_of(folder)
    return sorted(x.base_name for x in fs.get_file_info(_fs.FileSelector(path, allow_not_found=True)) if x.type == _fs.FileType.File)


def opened(name: str):
    """A file to seek and read in."""
    fs, path = store_of(name)
    return fs.open_input_file(path)


def delete(name: str) -> bool:
    """Take a file away; whether it was there."""
    fs, path = store_of(name)
    if fs.get_file_info(path).type != _fs.FileType.File:
        return False
    fs.delete_file(path)
    return True
