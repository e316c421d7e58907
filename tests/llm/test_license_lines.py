"""The license lines that documents hold, and notices that are too short for winnowing's guarantee."""

from lumbung.llm import licenses

from .fixtures import documents, words

LINES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved": "All rights reserved.",
}


def test_planted_lines(spark):
    rows, expected = [], []
    for i in range(300):
        name, line = list(LINES.items())[i % 5]
        before = f"{words(i % 17, i)} é\n"
        rows.append((i, f"{before}{line}\n{words(i % 13, i + 999)}", "en", "s"))
        expected.append((i, name, len(before), len(before) + len(line) - 1))
    found = licenses.scan(documents(spark, rows)).collect()
    assert sorted((r["doc_id"], r["license"], r["start"], r["end"]) for r in found) == expected


def test_short_notice():
    index = licenses.Index()
    names = lambda text: [(index.names[m.template], m.words) for _, m, _, _ in index.scan([text])]
    assert names("Copyright 2020 A. ALL RIGHTS RESERVED.") == [("all-rights-reserved", 3)] and names("All rights reserved. " * 3) == [("all-rights-reserved", 3)] * 3
    assert names("All rights reserved. No part of this work may be reproduced without permission.") == [("all-rights-reserved", 13)]
    assert names("all rights are reserved") == names("rights reserved") == []
