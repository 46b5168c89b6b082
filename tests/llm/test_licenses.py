"""Operator 3: places, labels and spans, edge cases."""

from llm_edges import EDGE_ROWS, docs, words  # noqa: F401

from ledgerspark.llm.license_diagonals import scan_licenses


def found(docs, *texts):
    rows = scan_licenses(docs(*enumerate(texts))).collect()
    return {r["doc_id"]: r for r in rows}


def test_base_places_and_method_labels(docs):
    got = found(
        docs,
        "Some words. Licensed under the Apache License, Version 2.0. More words",
        "MIT License! and mit-license and CC BY",
        "This work is licensed under GNU General Public License, version 3.",
        "licenses of nothing",
        "Released under MY the MIT License here and released under the mit license there",
        "Permission is granted, free of charge, to any person getting a copy of this software",
    )
    assert (got[0]["n_base"], got[0]["first_word"], got[0]["base_labels"], got[0]["labels"]) == (1, 5, "apache", "apache")
    assert (got[1]["n_base"], got[1]["first_word"], got[1]["last_word"]) == (3, 0, 6)
    assert got[1]["base_labels"] == "cc-by,mit"
    assert got[2]["labels"] == "gpl" and [s["template"] for s in got[2]["spans"]] == ["gpl"]
    assert (got[3]["n_base"], got[3]["labels"], got[3]["score"]) == (0, "", 0.0)
    # The inserted word moves the second half to a neighbouring diagonal.
    assert [s["template"] for s in got[4]["spans"]] == ["mit"] or len(got[4]["spans"]) == 2
    assert got[5]["n_base"] == 0 and got[5]["score"] in (0.0, got[5]["score"])


def test_inserted_word_is_bridged(docs):
    text = "permission is hereby granted free of charge to any lucky person obtaining a copy of this software"
    row = found(docs, text)[0]
    assert row["labels"] == "mit-text" and 0.7 <= row["score"] <= 1
    assert row["spans"][0]["begin"] == 0 and row["spans"][0]["end"] == len(text.split()) - 1


def test_restricted_variants_are_no_plain_attribution(docs):
    names = {"nc": "NonCommercial", "sa": "ShareAlike", "nd": "NoDerivatives"}
    codes = ["", "nc", "sa", "nd", "nc-sa", "nc-nd"]
    full = "".join
    texts = [
        full(["Text. This work is licensed under a Creative Commons Attribution", *["-" + names[c] for c in code.split("-") if c],
              " 4.0 International License. More text"])
        for code in codes
    ]
    got = found(docs, *texts, "Licensed under CC BY-NC-SA 4.0.")
    for i, code in enumerate(codes):
        label = "cc-by" + ("-" + code if code else "")
        assert (got[i]["labels"], got[i]["score"]) == (label, 1.0)
        assert [s["template"] for s in got[i]["spans"]] == [label]
    assert [s["template"] for s in got[6]["spans"]] == ["cc-by-nc-sa"]


def test_edges(docs):
    rows = scan_licenses(docs(*EDGE_ROWS, (9, "x " * 200_000 + "mit license"))).collect()
    assert len(rows) == len(EDGE_ROWS) + 1
    last = [r for r in rows if r["doc_id"] == 9][0]
    assert (last["n_words"], last["first_word"], last["labels"]) == (200_002, 200_000, "mit")
    assert all(r["n_base"] == 0 and r["first_word"] is None and r["score"] == 0 for r in rows if r["doc_id"] != 9)
    assert scan_licenses(docs()).count() == 0
