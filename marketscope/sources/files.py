"""Filesystem access for the few places that read or write files from Python
tasks (zip archives, registry-format export): through ``pyarrow.fs``, so a
path may be local, ``file://``, ``hdfs://`` or ``s3://``, whatever the
executors can reach."""

from __future__ import annotations

import pyarrow.fs as pafs


def resolve(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path.removeprefix("file:")


def list_files(path: str) -> list[str]:
    """Files directly under ``path``, sorted (full paths in the same form)."""
    fs, base = resolve(path)
    infos = fs.get_file_info(pafs.FileSelector(base, recursive=False))
    prefix = path[: len(path) - len(base)] if path.endswith(base) else ""
    return sorted(prefix + i.path for i in infos if i.type == pafs.FileType.File)


def open_input(path: str):
    """A seekable binary file (zipfile needs seeking)."""
    fs, p = resolve(path)
    return fs.open_input_file(p)


def open_output(path: str):
    fs, p = resolve(path)
    return fs.open_output_stream(p, compression=None)     # the bytes as given, whatever the name


def make_dirs(path: str) -> None:
    fs, p = resolve(path)
    fs.create_dir(p, recursive=True)


def move(src: str, dst: str) -> None:
    fs, s = resolve(src)
    _, d = resolve(dst)
    fs.move(s, d)


def join(path: str, name: str) -> str:
    return path.rstrip("/") + "/" + name
