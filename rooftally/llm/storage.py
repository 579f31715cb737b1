"""Binary files in the shared folder, written and read inside tasks.

A task writes under a name of its own and reports it in a manifest row. Only names in the manifest
count, so a task that runs twice, or dies halfway, leaves at most a file that nobody reads.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a URI, or of a bare path, which is taken as local."""
    return fs.FileSystem.from_uri(uri if ":" in uri.split("/")[0] else f"file://{uri}")


def new_name(folder: str, stem: str, suffix: str) -> str:
    return f"{folder}/{stem}-{uuid.uuid4().hex}{suffix}"


def create(uri: str):
    """An output stream to a new file. Folders on the way are made where the store has folders."""
    store, path = locate(uri)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return store.open_output_stream(path, compression=None, buffer_size=1 << 20)


def stream(uri: str):
    """An input stream from the start of a file, as its bytes are."""
    store, path = locate(uri)
    return store.open_input_stream(path, compression=None, buffer_size=1 << 20)


def random_access(uri: str):
    store, path = locate(uri)
    return store.open_input_file(path)


def remove(uri: str) -> None:
    """Delete a file, if an earlier attempt has not."""
    store, path = locate(uri)
    try:
        store.delete_file(path)
    except FileNotFoundError:
        pass
