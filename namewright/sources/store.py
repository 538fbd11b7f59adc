"""Folders and files by path, for tasks and streams that must see what Spark's own readers hide."""

import io
import os
import shutil
import time
from collections.abc import Iterator

_ATTEMPTS = 3
# What a folder or file may be without being a fault of the storage.
LASTING = (FileNotFoundError, PermissionError, NotADirectoryError, IsADirectoryError)


class Store:
    """Lists folders and opens files; one file system object per scheme and authority.

    Plain paths and ``file:`` URIs use the operating system and do not follow links to
    folders. Other URIs go through Arrow; the path behind the authority is taken as it
    stands, so listed paths keep the beginning of the folder they were found in.
    """

    def __init__(self):
        self._systems = {}

    def _remote(self, uri: str):
        scheme, rest = uri.split("://", 1)
        authority, _, path = rest.partition("/")
        scheme = "s3" if scheme in ("s3a", "s3n") else scheme
        if (scheme, authority) not in self._systems:
            from pyarrow import fs

            self._systems[scheme, authority] = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
        system, base = self._systems[scheme, authority]
        return system, f"{base.rstrip('/')}/{path}".rstrip("/") or "/"

    @staticmethod
    def _plain(path: str) -> str | None:
        if path.startswith("file:"):
            return "/" + path.removeprefix("file:").lstrip("/")
        return None if "://" in path else path

    def entries(self, folder: str) -> Iterator[tuple[bool, str, int]]:
        """(is_folder, path, bytes) of what a folder holds."""
        parent, plain = folder.rstrip("/"), self._plain(folder)
        if plain is not None:
            with os.scandir(plain) as found:
                for entry in found:
                    is_folder = entry.is_dir(follow_symlinks=False)
                    size = 0 if is_folder or entry.is_symlink() and not os.path.exists(entry.path) else entry.stat().st_size
                    yield is_folder, f"{parent}/{entry.name}", size
            return
        from pyarrow import fs

        system, base = self._remote(folder)
        for info in system.get_file_info(fs.FileSelector(base)):
            yield info.type == fs.FileType.Directory, f"{parent}/{info.base_name}", info.size or 0

    def create(self, path: str):
        """A new file for writing, with the folders it lies in."""
        plain = self._plain(path)
        if plain is not None:
            os.makedirs(os.path.dirname(plain), exist_ok=True)
            return open(plain, "wb")
        system, base = self._remote(path)
        system.create_dir(base.rsplit("/", 1)[0], recursive=True)
        return system.open_output_stream(base)

    def writes_anywhere(self, path: str) -> bool:
        """Can tasks write parts of one file side by side?"""
        return self._plain(path) is not None

    def create_sized(self, path: str, size: int) -> None:
        """A new file of ``size`` bytes for ``update``."""
        with self.create(path) as file:
            file.truncate(size)

    def update(self, path: str, at: int):
        """An existing file for writing from byte ``at`` on; not on every file system, see ``writes_anywhere``."""
        file = os.fdopen(os.open(self._plain(path), os.O_WRONLY), "wb")
        file.seek(at)
        return file

    def write(self, path: str, content: bytes) -> None:
        """Write a file, with the folders it lies in."""
        with self.create(path) as file:
            file.write(content)

    def append(self, path: str, content: bytes) -> None:
        """Put bytes behind what a file holds; a new file where there is none."""
        plain = self._plain(path)
        if plain is not None:
            os.makedirs(os.path.dirname(plain), exist_ok=True)
            with open(plain, "ab") as file:
                file.write(content)
            return
        system, base = self._remote(path)
        with system.open_append_stream(base) as file:
            file.write(content)

    def make_folder(self, path: str) -> None:
        plain = self._plain(path)
        if plain is not None:
            os.makedirs(plain, exist_ok=True)
            return
        system, base = self._remote(path)
        system.create_dir(base, recursive=True)

    def exists(self, path: str) -> bool:
        plain = self._plain(path)
        if plain is not None:
            return os.path.lexists(plain)
        from pyarrow import fs

        system, base = self._remote(path)
        return system.get_file_info(base).type != fs.FileType.NotFound

    def move(self, path: str, to: str) -> None:
        """Rename a file or folder within one file system; the new parent folder is made."""
        plain, target = self._plain(path), self._plain(to)
        if plain is not None and target is not None:
            os.makedirs(os.path.dirname(target), exist_ok=True)
            os.rename(plain, target)
            return
        (system, base), (_, target) = self._remote(path), self._remote(to)
        system.create_dir(target.rsplit("/", 1)[0], recursive=True)
        system.move(base, target)

    def delete(self, folder: str) -> None:
        """Remove a folder and what it holds, if there is one."""
        plain = self._plain(folder)
        if plain is not None:
            shutil.rmtree(plain, ignore_errors=True)
        elif self.exists(folder):
            system, base = self._remote(folder)
            system.delete_dir(base)

    def open(self, path: str):
        """A file for reading at any place, also by lines."""
        plain = self._plain(path)
        if plain is not None:
            return open(plain, "rb")
        system, base = self._remote(path)
        return io.BufferedReader(system.open_input_file(base))


def patiently(action):
    """``action()`` and no error, or None and why it can never work.

    A missing or forbidden path is told; any other fault of the storage, such as a time-out,
    is tried again and then ends the task, so that nothing goes missing without a trace.
    """
    for attempt in range(1, _ATTEMPTS + 1):
        try:
            return action(), None
        except LASTING as error:
            return None, type(error).__name__
        except OSError:
            if attempt == _ATTEMPTS:
                raise
            time.sleep(2**attempt)
