"""Files that tasks open themselves, by the addresses that Spark gives."""

from __future__ import annotations

import re
from urllib.parse import quote


def file_system(address: str):
    """The file system of an address and the path in it; signs in the address are taken as they are."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(quote(re.sub("^file:/+", "file:///", address), safe=":/@"))
