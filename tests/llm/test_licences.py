"""Sentences and rules on hand-written texts."""

from weblens.llm.licences import SENTENCES, scan_licences


def test_texts(spark):
    long_mit = SENTENCES["MIT-GRANT"].capitalize() + ".\n\n" + SENTENCES["MIT-NOTICE"]
    rows = [
        (1, "Prose.\nLicensed under the Apache License, Version 2.0.\nMore. Released under the MIT License."),
        (2, long_mit),
        (3, SENTENCES["MIT-NOTICE"] + ". " + SENTENCES["MIT-GRANT"]),  # the wrong order
        (4, "Released under the MIT License of ours"),
        (5, "RELEASED  under the `MIT` License!"),
        (6, SENTENCES["BSD-REDISTRIBUTE"] + ":\n" + SENTENCES["BSD-ENDORSE"]),
        (7, None),
        (None, ""),
        (8, "Released under the MIT License.\n" * 3000),
        (9, "All rights reserved."),
        (9, "All rights reserved."),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS licences")
    got = [(r.doc_id, r.licences) for r in scan_licences(docs).collect()]
    want = [
        (1, ["Apache-2.0", "MIT"]), (2, ["MIT"]), (3, []), (4, []), (5, ["MIT"]), (6, ["BSD-3-Clause"]),
        (7, []), (None, []), (8, ["MIT"]), (9, ["proprietary"]), (9, ["proprietary"]),
    ]
    assert sorted(map(str, got)) == sorted(map(str, want))
    sentences = {r.doc_id: r.sentences for r in scan_licences(docs).collect()}
    assert sentences[1] == ["APACHE2", "MIT"] and len(sentences[8]) == 3000


def test_own_tables_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "Alpha! Beta. Gamma")], "doc_id long, text string")
    got = scan_licences(docs, sentences={"A": "alpha", "B": "beta"}, rules={"A": "one", "A B": "two"})
    assert got.first().licences == ["two"]
    assert scan_licences(docs.limit(0)).count() == 0


MIT = """\
MIT License

Copyright (c) 2020 A. Author

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY.
"""
BSD_2 = """\
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_3 = f"""{BSD_2}
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
GPL = """\
This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
APACHE = """\
Licensed under the Apache License, Version 2.0 (the
"License"); you may not use this file except in
compliance with the License. You may obtain a copy of
the License at

    http://www.apache.org/licenses/LICENSE-2.0
"""


def found_in(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r.sentences, r.licences) for r in scan_licences(docs).orderBy("doc_id").collect()]


def test_wrapped_public_texts(spark):
    want = [
        (MIT, ["MIT-GRANT", "MIT-NOTICE"], ["MIT"]),
        (BSD_2, ["BSD-REDISTRIBUTE"], ["BSD-2-Clause"]),
        (BSD_3, ["BSD-REDISTRIBUTE", "BSD-ENDORSE"], ["BSD-3-Clause"]),
        (GPL, ["GPL-FREE", "GPL-WARRANTY"], ["GPL-3.0-or-later"]),
        (APACHE, ["APACHE2-THE", "APACHE2-USE", "APACHE2-COPY"], ["Apache-2.0"]),
    ]
    forms = [
        lambda t: t,
        lambda t: t.replace("\n", "\r\n"),
        lambda t: "\n\n".join(" ".join(p.split()) for p in t.split("\n\n")),  # a line a paragraph
        lambda t: "\n\n".join("\n".join(p.split()) for p in t.split("\n\n")),  # a line a word
        *[lambda t, s=s: "".join(f"{s}{x}\n" for x in t.splitlines()) for s in ("// ", "# ", "; ", " * ")],
        lambda t: "/*\n" + "".join(f" * {x:<78} *\n" for x in t.splitlines()) + " */\nint main;",
    ]
    got = found_in(spark, [form(t) for t, _, _ in want for form in forms])
    assert got == [(s, x) for _, s, x in want for _ in forms]


def test_sentences_end_at_stops_and_blank_lines(spark):
    texts = [
        "Some prose\nReleased under the MIT License\nmore prose",
        "Released under\nthe MIT License: ok",
        "Released under\n\nthe MIT License",
        "# Released under\n#\n# the MIT License",
        "Released under. The MIT License",
        "It is released under\nthe MIT License",
        "Licensed under the Apache License, Version 2.0\n(the License)",
    ]
    want = [["MIT"], ["MIT"], [], [], [], [], ["APACHE2-THE"]]
    assert [s for s, _ in found_in(spark, texts)] == want


def test_a_shorter_rule_counts_outside_longer_ones(spark):
    texts = [f"{BSD_2}\n\n{BSD_3}", f"{BSD_3}\n\n{BSD_2}", f"{BSD_3}\n\n{BSD_3}"]
    both = ["BSD-2-Clause", "BSD-3-Clause"]
    assert [x for _, x in found_in(spark, texts)] == [both, both, ["BSD-3-Clause"]]
    rows = [(0, "a. b. a"), (1, "b. a. b"), (2, "a. b. a. b. a"), (3, "a. b. a. c. b"), (4, "b. c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = {"A.": "a", "B": "b", "C": "c"}
    rules = {"A.": "one", "B": "two", "A. B A.": "three", "B C": "four", "C B": "five"}
    got = scan_licences(docs, sentences=known, rules=rules).orderBy("doc_id").collect()
    assert [r.licences for r in got] == [["three"], ["one", "two"], ["three"], ["five", "three"], ["four"]]
