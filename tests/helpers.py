"""Hand-written uploads for golden tests."""

from __future__ import annotations

import io
import os
import zipfile

TAB = "\t"


def write_zip(folder: str, name: str, members: dict[str, str] | None = None, raw: bytes | None = None) -> str:
    path = os.path.join(folder, name)
    if raw is not None:
        with open(path, "wb") as fh:
            fh.write(raw)
        return path
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        for member, text in (members or {}).items():
            zf.writestr(member, text)
    with open(path, "wb") as fh:
        fh.write(buf.getvalue())
    return path


def report(rows: list[tuple[str, str, str, str]], sep: str = TAB, chip: str | None = "CHIPX",
           header: tuple[str, ...] = ("SNP Name", "Sample ID", "Allele1 - AB", "Allele2 - AB")) -> str:
    out = ["[Header]"]
    if chip is not None:
        out.append(f"Content{sep}{sep}{chip}" if sep == TAB else f"Content{sep}{chip}")
    out.append("[Data]")
    out.append(sep.join(header))
    out += [sep.join(r) for r in rows]
    return "\r\n".join(out) + "\r\n"


def map_file(names: list[str], sep: str = TAB, header: tuple[str, ...] = ("Index", "Name", "Chromosome")) -> str:
    out = [sep.join(header)]
    out += [sep.join((str(i + 1), n, "1")) for i, n in enumerate(names)]
    return "\n".join(out) + "\n"
