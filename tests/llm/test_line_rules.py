from __future__ import annotations

import re
from collections import Counter, defaultdict

import duckdb
import pytest

from recordloom.llm import line_rules

from .conftest import words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shape(line):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), re.sub("[0-9]", "0", line))
    return " ".join(WORD.findall(lowered))


def plain(rows, most_docs, own_share, least_left):
    """Verdicts by the definitions, with texts and lines themselves."""
    holders, sizes = defaultdict(set), defaultdict(dict)
    for _, text, host in rows:
        for line in (text or "").split("\n"):
            if WORD.search(line):
                holders[host, shape(line)].add(text)
                sizes[host, text][shape(line)] = len(WORD.findall(line))
    content = {
        key for key, lines in sizes.items()
        if sum(n for x, n in lines.items() if len(holders[key[0], x]) == 1) >= own_share * sum(lines.values())
    }

    def documents(host, line):
        texts = holders[host, shape(line)]
        own = sum((host, t) in content for t in texts)
        return own + (own < len(texts))

    out = []
    for doc_id, text, host in rows:
        text = text or ""
        found = WORD.findall(text)
        windows = Counter(zip(found, found[1:], found[2:]))
        covered = {
            j for i in range(len(found) - 2) if windows[tuple(found[i : i + 3])] > 1 for j in (i, i + 1, i + 2)
        }
        lines = [x for x in text.split("\n") if WORD.search(x)]
        n = len(found)
        failed = n < 50 or 100 * len(covered) > 50 * n
        removed = sum(
            len(WORD.findall(x))
            for x in lines
            if documents(host, x) > most_docs
        )
        kept = not failed and n - removed >= least_left * n
        symbols = len(re.findall(r"[#*$%&|<>]", text))
        out.append((doc_id, n, len("".join(found)), symbols, len(lines) - len(set(lines)), len(covered), failed, kept, removed))
    return out


def prose(n, start):
    """Words that differ in letters, since digits are levelled in lines."""
    return words(n, start).translate(str.maketrans("0123456789", "abcdefghij"))


FIELDS = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept removed_words".split()


def check(docs, **limits):
    rows = [(r.doc_id, r.text, r.source) for r in docs.select("doc_id", "text", "source").collect()]
    found = line_rules.judged(docs, carry=["doc_id"], **limits).collect()
    expected = plain(rows, limits.get("most_docs", 10), limits.get("own_share", 0.2), limits.get("least_left", 0.3))
    assert sorted(map(str, expected)) == sorted(str((r.doc_id, *[r.rules[f] for f in FIELDS])) for r in found)
    return found


@pytest.mark.parametrize("frame", ["messy", "sample", "nothing"])
def test_figures_equal_the_definitions(frame, request):
    check(request.getfixturevalue(frame))


@pytest.fixture(scope="module")
def shared(docs_of):
    footer = "Subscribe NOW to our list of 12 offers and read all about it today"
    menu = "\n".join(f"{j} entry" + "".join(f" {j}{k}x" for k in "abcdefghijklm") for j in "pqrs")
    rows = [(i, prose(70, 100 * i) + "\n" + footer.replace("12", str(i + 10)), "a") for i in range(8)]
    rows += [(20 + i, menu + "\nown words " + prose(16, 20 * i), "a") for i in range(6)]
    rows += [(40 + i, prose(70, 5000) + "\na line that only copies hold", "a") for i in range(9)]  # copies of one text
    rows += [(60, prose(70, 9000) + "\n" + footer, "b")]  # the line is rare in this host
    # Near copies: nine lines of one text, one line of each its own.
    rows += [(80 + i, "\n".join([prose(12, 20000 + 50 * k) for k in range(9)] + [prose(6, 30000 + 50 * i)]), "a") for i in range(30)]
    # Pages of the menu alone, with hardly a word of their own.
    rows += [(120 + i, menu + "\n" + prose(4, 40000 + 50 * i), "a") for i in range(7)]
    return docs_of(rows)


def test_shared_lines_go_and_depleted_documents_fail(shared):
    limits = {"most_docs": 4}
    found = {r.doc_id: r.rules for r in check(shared, **limits)}
    assert all(found[i].removed_words == 14 and found[i].kept for i in range(8))
    assert not any(found[20 + i].kept or found[20 + i].base_failed for i in range(6))
    assert all(found[40 + i].removed_words == 0 and found[40 + i].kept for i in range(9))
    assert found[60].removed_words == 0 and found[60].kept
    assert all(found[80 + i].removed_words == 0 and found[80 + i].kept for i in range(30))
    assert not any(found[120 + i].kept for i in range(7))
    kept = line_rules.keep_good(shared, **limits)
    assert kept.columns == shared.columns
    texts = {r.doc_id: r for r in kept.collect()}
    assert texts[3].text == prose(70, 300) and texts[3].n_chars == len(texts[3].text)
    assert texts[60].text.endswith("today") and texts[60].n_chars == len(texts[60].text)


def test_the_limit_does_not_loosen_with_the_host(docs_of):
    footer = "all rights to this text are kept by its author in every land"
    rows = [(i, prose(60, 100 * i) + ("\n" + footer if i < 12 else ""), "big") for i in range(900)]
    found = {r.doc_id: r.rules.removed_words for r in check(docs_of(rows))}
    assert all(found[i] == (13 if i < 12 else 0) for i in range(900))


@pytest.mark.parametrize("own_share", [0.2, 0.0])
def test_shared_lines_are_rows_and_hot_lines_are_cut(shared, own_share):
    texts = line_rules.text_lines(shared)
    assert texts.count() == 8 + 6 + 1 + 1 + 30 + 7  # copies once
    rows = line_rules.shared_lines(texts, most_docs=4, own_share=own_share).collect()
    menu = [6 + (1 if own_share else 7)] * 4
    near = [] if own_share else [30] * 9  # every text counts
    assert sorted(r.docs for r in rows) == sorted([8, *menu, *near])
    check(shared, most_docs=4, chunk_rows=3, own_share=own_share)


def test_many_distinct_words_do_not_mix_up_triples(docs_of):
    check(docs_of([(1, words(3000) + " " + words(200, 40), "a")]))


def test_sql_agrees(sample):
    con = duckdb.connect()
    con.register("documents", sample.toPandas())
    expected = con.sql(line_rules.RULES_SQL).fetchall()
    found = line_rules.judged(sample, carry=["doc_id"]).select("doc_id", "rules.*").drop("removed_words").collect()
    assert sorted(expected) == sorted(tuple(r) for r in found)
