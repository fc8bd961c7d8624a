"""Paths and small helpers shared by the test modules."""

from __future__ import annotations

import os

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def write_files(root: str, files: dict[str, bytes | str]) -> None:
    for name, content in files.items():
        path = os.path.join(root, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(content.encode("utf-8") if isinstance(content, str) else content)
