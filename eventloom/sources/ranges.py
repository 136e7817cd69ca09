"""Files of a store and byte ranges of them, for sources that read ranges in tasks."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from urllib.parse import quote

# Path schemes that can be read, with the name under which pyarrow knows the store.
STORES = {"": "file", "file": "file", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs", "viewfs": "viewfs"}
# Fixed value: the marks of a path pattern.
_PATTERN = re.compile(r"[*?\[{]")


def scheme_of(path: str) -> str:
    """The scheme of a path as Spark writes it (blanks and ``%`` stand for themselves); ``""`` if it has none."""
    head, colon, _ = path.partition(":")
    return head.lower() if colon and "/" not in head else ""


def check_readable(paths: list[str]) -> None:
    """An error for a path whose store :func:`read_range` does not know."""
    unknown = sorted({s for s in map(scheme_of, paths) if s not in STORES})
    if unknown:
        raise ValueError(f"no byte ranges from {unknown}: pass read_range, or use one of {sorted(s for s in STORES if s)}")


def filesystem_of(path: str):
    """The store of a path as a pyarrow file system, and the path in it; credentials are those of the process's environment."""
    from pyarrow import fs

    check_readable([path])
    store = STORES[scheme_of(path)]
    rest = path.partition(":")[2] if scheme_of(path) else path
    if store == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{store}:{quote(rest)}")


def read_range(path: str, start: int, size: int) -> bytes:
    """``size`` bytes of a file from ``start``."""
    filesystem, inner = filesystem_of(path)
    with filesystem.open_input_file(inner) as f:
        return bytes(f.read_at(size, start))


def file_exists(path: str) -> bool:
    from pyarrow import fs

    store, inner = filesystem_of(path)
    return store.get_file_info(inner).type == fs.FileType.File


def write_file(path: str, content: bytes) -> None:
    """A small file, written whole; its folder is made if there is none."""
    store, inner = filesystem_of(path)
    store.create_dir(inner.rpartition("/")[0], recursive=True)
    with store.open_output_stream(inner) as f:
        f.write(content)


def shown(path: str) -> str:
    """A path as Spark's ``_metadata.file_path`` shows it."""
    scheme = scheme_of(path) or "file"
    rest = path.partition(":")[2] if scheme_of(path) else path
    return f"file:{quote('/' + rest.lstrip('/'))}" if scheme == "file" else f"{scheme}://{quote(rest.removeprefix('//'))}"


def _name_pattern(name: str) -> re.Pattern:
    """A path pattern's name (``*``, ``?``, ``[a-z]``, ``{a,b}``) as a regular expression."""
    out, depth = [], 0
    for part in re.split(r"(\[[^\]]+\]|[*?{},])", name):
        if part.startswith("[") and part.endswith("]"):
            out.append("[^" + part[2:] if part[1] in "^!" else part)
        elif part == "{" or part == "}" and depth:
            depth += 1 if part == "{" else -1
            out.append("(?:" if part == "{" else ")")
        else:
            out.append({"*": ".*", "?": "."}.get(part) or ("|" if part == "," and depth else re.escape(part)))
    return re.compile("".join(out))


def list_files(paths: list[str]) -> Iterator[tuple[str, int]]:
    """(path, length) of the files that Spark's readers see under ``paths``: files, folders and patterns.

    Names that start with ``_`` or ``.`` are hidden; a folder's subfolders count if they are named ``key=value``.
    """
    from pyarrow import fs

    def inside(store, folder: str) -> list:
        found = store.get_file_info(fs.FileSelector(folder or "/", recursive=False))
        return sorted((i for i in found if i.base_name[:1] not in ("_", ".")), key=lambda i: i.path)

    def files(store, info) -> Iterator:
        if info.type == fs.FileType.File:
            yield info
        elif info.type == fs.FileType.Directory:
            for i in inside(store, info.path):
                if i.type == fs.FileType.File or "=" in i.base_name:
                    yield from files(store, i)

    for path in paths:
        path = path if scheme_of(path) else os.path.abspath(path)
        store, inner = filesystem_of(path)
        head = path[: len(path) - len(inner.lstrip("/"))] if path.endswith(inner.lstrip("/")) else "file:///"
        names = inner.strip("/").split("/")
        fixed = next((i for i, n in enumerate(names) if _PATTERN.search(n)), len(names))
        root = ("/" if inner.startswith("/") else "") + "/".join(names[:fixed])
        infos = [store.get_file_info(root or "/")]
        for name in names[fixed:]:
            pattern = _name_pattern(name)
            infos = [i for d in infos if d.type == fs.FileType.Directory for i in inside(store, d.path) if pattern.fullmatch(i.base_name)]
        found = [f for i in infos for f in files(store, i)]
        if not found and (fixed < len(names) and not infos or infos and infos[0].type == fs.FileType.NotFound):
            raise FileNotFoundError(f"no files at {path}")
        for f in found:
            yield head + f.path.lstrip("/"), f.size
