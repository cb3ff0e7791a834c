"""Opening files from inside tasks."""

from __future__ import annotations

from urllib.parse import urlsplit

# Names under which Spark's file systems and Arrow's know the same store.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}
LOCAL = ("", "file")
# A mounted folder that every machine sees below this path.
MOUNTED = {"dbfs": "/dbfs"}


class Opener:
    """File system and location of paths and URIs, local or remote; one client per scheme and host."""

    def __init__(self) -> None:
        self.clients: dict[tuple[str, str], object] = {}

    def __call__(self, path: str):
        from pyarrow import fs

        scheme, colon, rest = path.partition(":")
        if not colon or "/" in scheme:
            scheme, rest = "", path
        if scheme in LOCAL or scheme in MOUNTED:
            plain = rest if scheme == "" else "/" + rest.lstrip("/")
            return fs.LocalFileSystem(), MOUNTED.get(scheme, "") + plain
        known = SCHEMES.get(scheme, scheme)
        parts = urlsplit(f"{known}:{rest}")
        client = self.clients.get((known, parts.netloc))
        if client is None:
            client, location = fs.FileSystem.from_uri(f"{known}:{rest}")
            self.clients[known, parts.netloc] = client
            return client, location
        # Object stores have the bucket or container in the location, file systems don't.
        bucket = parts.netloc.rsplit("@", 1)[0] if known in ("s3", "gs", "abfs", "abfss") else ""
        return client, f"{bucket}{parts.path}"


def open_location(path: str):
    """File system and location of one path or URI."""
    return Opener()(path)
