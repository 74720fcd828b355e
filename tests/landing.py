"""Small helpers that put log files where the readers look for them."""

import os
from urllib.parse import quote


def land(root, server, path, data: bytes, segment="0001.log"):
    leaf = os.path.join(str(root), f"server_id={server}", "source_file_path=" + quote(path, safe=""))
    os.makedirs(leaf, exist_ok=True)
    with open(os.path.join(leaf, segment), "wb") as f:
        f.write(data)


def split_lines(data: bytes) -> list[str]:
    """Lines as a text reader sees them: ended by LF, CR LF or CR."""
    text = data.decode("utf-8", "replace").replace("\r\n", "\n").replace("\r", "\n")
    lines = text.split("\n")
    return lines[:-1] if lines[-1] == "" else lines
