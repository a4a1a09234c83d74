"""Files of a job's own formats, in any store that Arrow's file systems reach."""

from __future__ import annotations

from pyarrow import fs


def located(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def create(uri: str):
    """A stream to a new file; its folder is made where the store has folders."""
    store, path = located(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    return store.open_output_stream(path, compression=None)


def opened(uri: str):
    """A file that can be read from any place."""
    store, path = located(uri)
    return store.open_input_file(path)
