from shelfwise.llm import license_table, licenses

FULL = {
    "Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0-only", "GPL-3": "GPL-3.0-only",
    "LGPL-2.1": "LGPL-2.1-only", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0",
}
NOTICES = {
    "Licensed under the Apache License, Version 1.1": "Apache-1.1",
    "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0-only",
    "This software is released under the GNU GPL v3 or later.": "GPL-3.0-or-later",
    "Licensed under CC BY-SA 3.0.": "CC-BY-SA-3.0",
    "This work is licensed under the Creative Commons Attribution 4.0 International Licence.": "CC-BY-4.0",
    "SPDX-License-Identifier: LGPL-2.1-or-later": "LGPL-2.1-or-later",
    "Released under the BSD 3-Clause License.": "BSD-3-Clause",
    "Licensed under the LGPLv3.": "LGPL-3.0-only",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
}


def test_common_licences_are_known(spark):
    texts = {f"file {k}": ((license_table.TEXTS / f"{k}.txt").read_text(), v) for k, v in FULL.items()}
    apache = texts["file Apache-2.0"][0]
    texts["cut"] = (apache[: apache.index("APPENDIX")], "Apache-2.0")
    bsd = (license_table.TEXTS / "BSD.txt").read_text()
    texts["bsd"] = (bsd, "BSD-3-Clause")
    texts["two"] = (bsd[: bsd.index("3. Nei")] + bsd[bsd.index("\nTHIS SOFT") :], "BSD-2-Clause")
    texts["free"] = (license_table.UNLICENSE, "Unlicense")
    texts["mit"] = (licenses.KNOWN[0][1].replace("MIT License", "The MIT License (MIT)"), "MIT")
    texts["open"] = (apache + "\nOne more term.", None)
    texts |= {k: (k, v) for k, v in NOTICES.items()}
    rows = [(k, t) for k, (t, _) in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    got = {r.doc_id: r.license for r in licenses.scan(docs).collect()}
    assert got == {k: v for k, (_, v) in texts.items()}


def test_no_text_has_two_names(spark):
    pairs = spark.createDataFrame(licenses.known_texts(), "license string, text string")
    whole = licenses.digest_of(licenses.F.array_join(licenses.canonical_lines(pairs["text"]), " "))
    twice = pairs.groupBy(whole.alias("d")).agg(licenses.F.collect_set("license").alias("l"))
    assert twice.where("size(l) > 1").collect() == []
