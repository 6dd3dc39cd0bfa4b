"""Raw files in the shared folder, from driver and executors alike, through pyarrow's file systems."""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs


def open_store(root: str) -> tuple[pafs.FileSystem, str]:
    """(file system, path) of a URI or plain path."""
    return pafs.FileSystem.from_uri(root if "://" in root or root.startswith("/") else f"file:{root.removeprefix('file:')}")


def put(root: str, name: str, write) -> str:
    """write(stream) to a file of its own, then moved to its name: a second attempt replaces the first whole."""
    store, path = open_store(root)
    store.create_dir(path, recursive=True)
    part = f"{path}/.{name}.{uuid.uuid4().hex}"
    try:
        with store.open_output_stream(part, compression=None, buffer_size=1 << 20) as out:
            write(out)
        try:
            store.move(part, f"{path}/{name}")
        except OSError:  # stores that refuse to replace what an earlier attempt left
            store.delete_file(f"{path}/{name}")
            store.move(part, f"{path}/{name}")
    except BaseException:
        try:
            store.delete_file(part)
        except OSError:
            pass
        raise
    return f"{path}/{name}"
