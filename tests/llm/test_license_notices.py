"""Families, wrapped headers, changed wordings and several notices in one place."""

import re

import pytest

from salarium.llm import license_scan
from salarium.llm.queries import op4_license_scan

DIR = "/root/testdata/sf0.01"
NOTICE = {
    "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0",
    "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0",
    "Released under the MIT License.": "mit",
    "Licensed under the Apache License, Version 2.0.": "apache-2.0",
    "All rights reserved.": "all-rights-reserved",
}
FAMILIES = {
    "SPDX-License-Identifier: MIT": "mit", "SPDX-License-Identifier: GPL-2.0-or-later": "gpl-2.0", "// SPDX-License-Identifier: ISC": "isc",
    "Licensed under the GNU General Public License, version 2.": "gpl-2.0", "GNU Affero General Public License v3.0": "agpl-3.0",
    "Distributed under the GNU Lesser General Public License, version 2.1": "lgpl-2.1", "SPDX-License-Identifier: LGPL-3.0-only": "lgpl-3.0",
    "Licensed under CC BY-SA 4.0.": "cc-by-sa-4.0", "Released under CC0 1.0 Universal": "cc0-1.0", "Released under the ISC License": "isc",
    "This program is made available under the terms of the Eclipse Public License v. 2.0": "epl-2.0",
    "This is free and unencumbered software released into the public domain.": "unlicense",
    "Copyright 2020 The Authors. All rights reserved.": "all-rights-reserved",
}
WRAPPED = {
    "mit": "# Permission is hereby granted, free of charge, to any person obtaining a copy\n# of this software and associated documentation files (the \"Software\"), to deal",
    "bsd": " * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following conditions\n * are met:",
    "gpl-3.0": "// This program is free software: you can redistribute it and/or modify\n// it under the terms of the GNU General Public License as published by\n"
               "// the Free Software Foundation, either version 3 of the License, or",
}
VARIANTS = {
    "Licensed under the MIT License": "mit", "released under the terms of the MIT license": "mit", "Released under an MIT Licence.": "mit",
    "Apache License 2.0": "apache-2.0", "Distributed under the Apache License, Version 2.0.": "apache-2.0",
    "Released under the simplified BSD License": "bsd", "Licensed under the CC BY 4.0 terms": "cc-by-4.0", "Shared under CC BY-NC 4.0": "cc-by-nc-4.0",
}
DUAL = [
    ("Licensed under either of the Apache License, Version 2.0 or the MIT License at your option", {"apache-2.0", "mit"}),
    ("SPDX-License-Identifier: Apache-2.0 OR MIT", {"apache-2.0", "mit"}),
    ("Released under the MIT License. " + "word " * 3000 + "Licensed under CC BY 4.0. " + "word " * 500, {"mit", "cc-by-4.0"}),
]
NONE = ["the MIT campus was released from a license", "all rights of way are reserved for trains", "a license plate under the bridge"]


@pytest.fixture(scope="module")
def found(spark):
    """Rows of the query's templates over the documents and the texts above, as {id: {(line, family)}}."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text")
    lines = [*FAMILIES, *VARIANTS, *[t for t, _ in DUAL], *NONE]
    extra = [(t, f"some words before\n{t}\nsome words after") for t in lines] + [(f, f"int x;\n{t}\nint y;") for f, t in WRAPPED.items()]
    both = docs.selectExpr("string(doc_id) AS doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id string, text string"))
    out = {}
    for r in license_scan.scan(both, license_scan.TEMPLATES | license_scan.RESERVED).collect():
        out.setdefault(r.doc_id, set()).add((r.paragraph, r.family))
    return out


def test_query_returns_every_notice_of_the_documents(spark):
    want = set()
    for r in spark.read.parquet(f"{DIR}/documents.parquet").collect():
        for i, line in enumerate(r.text.split("\n")):
            want |= {(r.doc_id, i, family) for notice, family in NOTICE.items() if re.search(re.escape(notice), line, re.I)}
    rows = op4_license_scan(spark, DIR).collect()
    assert {"all-rights-reserved"} < {f for _, _, f in want} and {(r.doc_id, r.paragraph, r.family) for r in rows} == want
    assert len(rows) == len(want)


def test_families(found):
    assert {t: found.get(t) for t in FAMILIES} == {t: {(1, f)} for t, f in FAMILIES.items()}


def test_wrapped_headers(found):
    assert {f: found.get(f) for f in WRAPPED} == {f: {(1, f)} for f in WRAPPED}


def test_changed_inserted_and_left_out_words(found):
    assert {t: found.get(t) for t in VARIANTS} == {t: {(1, f)} for t, f in VARIANTS.items()}


def test_several_notices_in_one_line(found):
    assert [{f for _, f in found.get(t, ())} for t, _ in DUAL] == [families for _, families in DUAL]


def test_licence_words_alone_are_no_notice(found):
    assert not [t for t in NONE if t in found]


def test_copies_take_no_place_of_the_sample(spark):
    rows = [(i, f"line {i % 40} of copies") for i in range(2000)] + [(i, f"text {i} alone") for i in range(3000, 3300)]
    read = license_scan.texts(spark.createDataFrame(rows, "doc_id long, text string"), "text", "doc_id")
    known = license_scan._templates(spark, license_scan.TEMPLATES)
    assert license_scan._sample(read, known, 200).distinct().count() == 200
