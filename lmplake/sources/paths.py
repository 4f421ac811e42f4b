"""Small file-system helpers (existence, markers, folder removal) through
``pyarrow.fs``, so they work on local, HDFS or object-store paths alike."""

from __future__ import annotations

import os


def fs_for(path: str):
    from pyarrow import fs as pafs
    if "://" not in path:
        path = os.path.abspath(path[len("file:"):] if path.startswith("file:") else path)
    return pafs.FileSystem.from_uri(path)


def exists(path: str) -> bool:
    from pyarrow import fs as pafs
    fsys, p = fs_for(path)
    return fsys.get_file_info(p).type != pafs.FileType.NotFound


def touch(path: str) -> None:
    fsys, p = fs_for(path)
    with fsys.open_output_stream(p) as out:
        out.write(b"")


def remove_dir(path: str) -> None:
    fsys, p = fs_for(path)
    if exists(path):
        fsys.delete_dir(p)


def sub_dirs(path: str) -> list[str]:
    from pyarrow import fs as pafs
    fsys, p = fs_for(path)
    infos = fsys.get_file_info(pafs.FileSelector(p, allow_not_found=True))
    return sorted(f"{path.rstrip('/')}/{i.base_name}" for i in infos if i.type == pafs.FileType.Directory)


def newest(path: str) -> float:
    """Modification time (seconds) of the newest entry below ``path``."""
    from pyarrow import fs as pafs
    fsys, p = fs_for(path)
    infos = [fsys.get_file_info(p), *fsys.get_file_info(pafs.FileSelector(p, recursive=True, allow_not_found=True))]
    return max([i.mtime.timestamp() for i in infos if i.mtime is not None], default=0.0)


def move(src: str, dst: str) -> None:
    fsys, s = fs_for(src)
    _, d = fs_for(dst)
    fsys.create_dir(d.rsplit("/", 1)[0], recursive=True)
    fsys.move(s, d)


def delete_file(path: str) -> None:
    fsys, p = fs_for(path)
    fsys.delete_file(p)


def day_folders(root: str, days, column: str = "pricedate") -> list[str]:
    """The existing ``column=<day>`` folders of ``root`` for ``days``."""
    def name(d) -> str:
        if d is None:  # the folder that Spark gives to a NULL partition value
            return "__HIVE_DEFAULT_PARTITION__"
        return d.isoformat() if hasattr(d, "isoformat") else str(d)

    there = {p.rsplit("/", 1)[-1] for p in sub_dirs(root)}  # one listing, not one probe a day
    return [f"{root.rstrip('/')}/{n}" for n in (f"{column}={name(d)}" for d in days) if n in there]
