"""Cases that an operator once left out."""

from __future__ import annotations

import random

import pytest

from test_edges import DOCS
from textloom.llm import licenses, pii, quality


def test_long_lines_count_as_boilerplate(spark):
    random.seed(3)
    body = lambda n: " ".join("".join(random.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    notice = body(120)
    rows = [(k, f"{notice}\n{body(80)}", "en", "h", 0) for k in range(30)] + [(100, f"{notice}\n{body(20)}", "en", "h", 0), (200, f"{notice}\n{body(20)}", "en", "other", 0)]
    out = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, DOCS)).collect()}
    assert all(out[k].removed_words == 120 and out[k].kept for k in range(30))
    assert out[100].removed_words == 120 and not out[100].kept
    assert out[200].removed_words == 0 and out[200].kept


def test_terms_far_from_the_entity_disclose_it(spark):
    fill = "some plain words that stand in every text of this table and part the two by far more than ten of them"
    rows = [(k, f"Marguerite {fill} {k} +1 234 555 0199", "", "", 0) for k in range(4)]
    rows += [(10 + k, f"Bartholomew {fill} {fill} {x}.{k}q@corp.example", "", "", 0) for k, x in enumerate(["anna", "otto", "ines", "karl"])]
    rows += [(30 + k, f"{fill} {k}", "", "", 0) for k in range(30)]
    out = {r.doc_id: r for r in pii.sanitised(spark.createDataFrame(rows, DOCS)).collect()}
    told = lambda r: [r.text[x.start : x.end] for x in r.spans if x.kind == "term"]
    assert all(told(out[k]) == ["Marguerite"] for k in range(4))
    assert all(told(out[10 + k]) == ["Bartholomew"] for k in range(4))
    assert not any(out[30 + k].spans for k in range(30))


def test_terms_on_the_given_tables(spark, data):
    """Every value and every part stands in fewer than MIN_TEXTS texts of sf0.001: no term can be found there."""
    texts = {r.text for r in spark.read.parquet(f"{data}/documents.parquet").select("text").collect() if r.text}
    seen = [e for t in texts for e in pii.entities(pii.find(t))]
    assert seen and max(map(seen.count, seen)) < pii.MIN_TEXTS
    assert pii.disclosing(spark.read.parquet(f"{data}/documents.parquet")).count() == 0


_BSD = """ * Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
 * 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
 * 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_NAMES = " * {}. Neither the name of the University nor the names of its contributors may be used to endorse or promote products derived from this software.\n"
_END = " * THIS SOFTWARE IS PROVIDED BY THE REGENTS AND CONTRIBUTORS ``AS IS'' AND ANY EXPRESS"
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_GNU = "it under the terms of the GNU {} as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version."


@pytest.mark.parametrize("text, labels", [
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction", {"mit"}),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal with the Software without restriction", {"ncsa"}),
    (_BSD + _END, {"bsd", "bsd-2-clause"}), (_BSD + _NAMES.format(3) + _END, {"bsd", "bsd-3-clause"}),
    (_BSD + " * 3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software.\n" + _NAMES.format(4) + _END, {"bsd", "bsd-4-clause"}),
    (_ISC + ", provided that the above copyright notice and this permission notice appear in all copies.", {"isc"}), (_ISC + ".", {"0bsd"}),
    ("Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely", {"zlib"}),
    (_GNU.format("General Public License", 2), {"gpl", "gpl-2.0"}), (_GNU.format("Lesser General Public License", "2.1"), {"lgpl-2.1"}), (_GNU.format("Affero General Public License", 3), {"agpl-3.0"}),
    ("Permission is granted to enter the building in binary form", set()),
])
def test_license_texts_without_a_name(text, labels):
    assert set(licenses.scan(text)["labels"]) == labels


@pytest.mark.parametrize("text, labels", [
    ("ISC License, Apache-2.0", {"isc", "apache-2.0"}), ("zlib license, BSD license", {"zlib", "bsd"}), ("X11 License, MPL-2.0, PHP License", {"x11", "mpl-2.0", "php"}),
    ("licensed under the ISC License", {"isc"}), ("Redistributed under the GNU Lesser General Public License v2.1", {"lgpl-2.1"}),
])
def test_license_lists_keep_all_labels(text, labels):
    assert set(licenses.scan(text)["labels"]) == labels
