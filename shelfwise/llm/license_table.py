"""The table of known licences: full texts beside this module, and one-line notices."""

from __future__ import annotations

import re
from functools import cache
from itertools import product
from pathlib import Path

TEXTS = Path(__file__).parent / "license_texts"

# SPDX names of the texts in files. A text says nothing of later versions, so
# it stands for the name without them.
FILES = {
    "Apache-2.0": "Apache-2.0",
    "CC0-1.0": "CC0-1.0",
    "GFDL-1.2": "GFDL-1.2-only",
    "GFDL-1.3": "GFDL-1.3-only",
    "GPL-1": "GPL-1.0-only",
    "GPL-2": "GPL-2.0-only",
    "GPL-3": "GPL-3.0-only",
    "LGPL-2": "LGPL-2.0-only",
    "LGPL-2.1": "LGPL-2.1-only",
    "LGPL-3": "LGPL-3.0-only",
    "MPL-1.1": "MPL-1.1",
    "MPL-2.0": "MPL-2.0",
}
#: Where the advice on applying a licence begins, which copies often leave out.
ADVICE = re.compile(r"(?<=END OF TERMS AND CONDITIONS)\s|^ADDENDUM: How to use", re.M)

UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means.

In jurisdictions that recognize copyright laws, the author or authors
of this software dedicate any and all copyright interest in the
software to the public domain. We make this dedication for the benefit
of the public at large and to the detriment of our heirs and
successors. We intend this dedication to be an overt act of
relinquishment in perpetuity of all present and future rights to this
software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR
OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
OTHER DEALINGS IN THE SOFTWARE.
"""
FOR_MORE = "\nFor more information, please refer to <{}://unlicense.org{}>\n"

FORMS = ("Licensed under", "Released under", "Distributed under", "Available under")
SUBJECTS = ("", "This work is ", "This software is ", "This project is ", "This document is ")


def _bsd() -> list[tuple[str, str]]:
    """Two and three clauses, of the university and of any holder, with usual headings."""
    regents = (TEXTS / "BSD.txt").read_text().split("reserved.\n", 1)[1]
    holder = (
        regents.replace("the University", "the copyright holder")
        .replace("THE REGENTS AND", "THE COPYRIGHT HOLDERS AND")
        .replace("THE REGENTS OR", "THE COPYRIGHT HOLDER OR")
    )
    out = []
    for body, clauses, numbers in product((regents, holder), (2, 3), (True, False)):
        if clauses == 2:
            body = re.sub(r"3\. Neither.*?permission\.\n", "", body, flags=re.S)
        if not numbers:
            body = re.sub(r"^[123]\. ", "", body, flags=re.M)
        heads = ("", f"BSD {clauses}-Clause License\n", f"The BSD {clauses}-Clause License\n")
        for head, rights in product(heads, ("", "All rights reserved.\n")):
            out.append((f"BSD-{clauses}-Clause", head + rights + body))
    return out


def _names() -> list[tuple[str, str]]:
    """(SPDX name, what a notice calls it); punctuation and case do not count."""
    out = [(x, f"{x} license") for x in ("MIT", "ISC", "Unlicense")]
    out += [("Unlicense", "Unlicense"), ("CC0-1.0", "CC0 1.0"), ("CC0-1.0", "CC0 1.0 Universal")]
    for clauses in (2, 3):
        name = f"BSD-{clauses}-Clause"
        out += [(name, f"{name} License"), (name, f"{clauses}-Clause BSD License")]
    for family, whole, versions in (
        ("Apache", "Apache", ("1.0", "1.1", "2.0")),
        ("MPL", "Mozilla Public", ("1.0", "1.1", "2.0")),
    ):
        for v in versions:
            called = (f"{whole} License version {v}", f"{whole} License {v}", f"{family} {v}")
            out += [(f"{family}-{v}", x) for x in (*called, f"{family} {v} License")]
    for family, whole, versions in (
        ("GPL", "General Public License", ("1.0", "2.0", "3.0")),
        ("LGPL", "Lesser General Public License", ("2.1", "3.0")),
        ("LGPL", "Library General Public License", ("2.0",)),
        ("AGPL", "Affero General Public License", ("1.0", "3.0")),
        ("GFDL", "Free Documentation License", ("1.1", "1.2", "1.3")),
    ):
        for v, short in product(versions, (False, True)):
            if short and not v.endswith(".0"):
                continue
            number = v.removesuffix(".0") if short else v
            called = [f"{x}{whole}{y} {number}" for x in ("GNU ", "") for y in (" version", "")]
            called += [f"{x}{family}{y}{number}" for x in ("GNU ", "") for y in (" version ", " ", "v", "-")]
            for x in called:
                out.append((f"{family}-{v}-only", x))
                out.append((f"{family}-{v}-only", f"{x} only"))
                for later in ("or later", "or any later version", "or (at your option) any later version"):
                    out.append((f"{family}-{v}-or-later", f"{x} {later}"))
    words = {"BY": "Attribution", "NC": "NonCommercial", "ND": "NoDerivatives", "SA": "ShareAlike"}
    for terms in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        whole = " ".join(words[x] for x in terms.split("-"))
        for v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            for x in (f"CC {terms} {v}", f"Creative Commons {whole} {v}"):
                area = {"4.0": "International", "3.0": "Unported"}.get(v, "Generic")
                for end in ("", " License", f" {area}", f" {area} License"):
                    out.append((f"CC-{terms}-{v}", x + end))
    return out


@cache
def common() -> tuple[tuple[str, str], ...]:
    """(SPDX name, text or notice) of the common licences; the README lists them."""
    out = []
    for file, name in FILES.items():
        text = (TEXTS / f"{file}.txt").read_text()
        out += [(name, text), (name, ADVICE.split(text, 1)[0])]
    out += _bsd()
    links = ("", *(FOR_MORE.format(*x) for x in product(("http", "https"), ("", "/"))))
    out += [("Unlicense", UNLICENSE + x) for x in links]
    names = _names()
    for (name, called), subject, form, the in product(names, SUBJECTS, FORMS, ("", "the ")):
        out.append((name, f"{subject}{form} {the}{called}"))
    out += [(x, f"SPDX-License-Identifier: {x}") for x in {n for n, _ in out} | {n for n, _ in names}]
    return tuple(out)
