"""Operator 8: figures against brute force, line rules, edge cases."""

from collections import Counter

from llm_edges import EDGE_ROWS, docs, words  # noqa: F401

from ledgerspark.llm.line_quality import LineRules, clean_lines, judge, reject_documents, repeated_window_words


def brute_repeat(words, k=8):
    grams = [tuple(words[i : i + k]) for i in range(len(words) - k + 1)]
    count = Counter(grams)
    hit = set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            hit.update(range(i, i + k))
    return len(hit)


def test_repeated_windows_match_brute_force(words):
    for n in (0, 1, 7, 8, 9, 16, 40, 200):
        text = [w.encode() for w in words(n)]
        text = text + text[: n // 2] + [b"x"] + text[n // 3 :]
        assert repeated_window_words(text) == brute_repeat(text)
    assert repeated_window_words([b"a"] * 20) == 20


def test_lines_fail_by_rule():
    good = b"A plain sentence of some words, which stays as it is."
    for bad in (b"home | about | news | contact", b"buy### now### cheap$$$ stuff%%%", b"NOW!! NOW!! HERE!!", b"Please accept cookies to go on", b"x x x x x x"):
        found = judge(good + b"\n" + bad, LineRules(min_words=5))
        assert found.cleaned == good, bad
    assert judge(good, LineRules()).lost_chars == 0


def test_document_losing_most_text_is_rejected():
    text = "\n".join([f"home{i} | about | news" for i in range(3)] + [f"word{i} here is fine." for i in range(5)])
    found = judge(text.encode(), LineRules())
    assert not found.base_failed and found.kept
    text = "\n".join([f"home{i} | about{i} | news | more | again" for i in range(20)] + ["One good line stays."])
    found = judge(text.encode(), LineRules())
    assert not found.base_failed and not found.kept


def test_edges_and_clashing_columns(docs):
    rows = clean_lines(docs(*EDGE_ROWS)).collect()
    assert len(rows) == len(EDGE_ROWS)
    assert all(r["base_failed"] and not r["kept"] for r in rows)
    assert {r["n_words"] for r in rows if r["text"] is None} == {0}
    long = "word " * 5 + "long" * 200_000
    row = clean_lines(docs((9, long))).first()
    assert row["word_chars"] == 20 + 800_000
    assert clean_lines(docs()).count() == 0
    assert reject_documents(docs(*EDGE_ROWS)).columns == docs().columns


def test_rejecting_keeps_cleaned_text(docs):
    good = " ".join(f"word{i}" for i in range(30)) + "."
    out = reject_documents(docs((1, good + "\nhome | about | news"), (2, "short"), (1, good + "\nhome | about | news"))).collect()
    assert [r["text"] for r in out] == [good, good]
    assert {r["n_chars"] for r in out} == {len(good)}
