"""Keys of local files in an object store, and back; no store is called here."""

from __future__ import annotations

from pathlib import Path, PurePosixPath


def parse_root(uri: str) -> tuple[str, str]:
    """Bucket and prefix of an s3:// or s3a:// address."""
    scheme, found, rest = uri.partition("://")
    bucket, _, prefix = rest.partition("/")
    if not found or scheme not in ("s3", "s3a") or not bucket:
        raise ValueError(f"not an object-store address: {uri!r}")
    return bucket, prefix.strip("/")


def join_key(*parts: str) -> str:
    return "/".join(p for p in (str(x).strip("/") for x in parts) if p)


def key_of(path: str | Path, base: str | Path, *prefix: str) -> str:
    """Key of a local file below base."""
    return join_key(*prefix, Path(path).resolve().relative_to(Path(base).resolve()).as_posix())


def path_of(key: str, base: str | Path, *prefix: str) -> Path:
    """Local file of a key below the prefix; a folder mark or a key elsewhere is an error."""
    root = join_key(*prefix)
    if key.endswith("/") or (root and not key.startswith(f"{root}/")):
        raise ValueError(f"no file below {root!r}: {key!r}")
    inner = PurePosixPath(key[len(root) + 1 if root else 0 :])
    if ".." in inner.parts:
        raise ValueError(f"key leaves its folder: {key!r}")
    return Path(base) / inner


def local_files(base: str | Path) -> list[Path]:
    return sorted(p for p in Path(base).rglob("*") if p.is_file())
