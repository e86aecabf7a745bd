"""Spelling variants against brute force over all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ticketry.llm import spelling as S
from ticketry.llm.spelling import hashed_rotations, rotations, spelling_variants, variants, vocabulary

SCHEMA = "doc_id long, text string, word string, n int, id int, key string, best int, form string"
COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def docs(spark, rows):
    """(doc_id, text) rows, with further columns under names that the operator uses."""
    return spark.createDataFrame([(*r, "x", 1, 1, "x", 1, "x") for r in rows], SCHEMA).repartition(3)


def near(a, b):
    """Whether one inserted, deleted or replaced code point makes one word the other."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counted(rows, altered=97, points=5, times=3):
    words = Counter()
    for d, text in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            words[run[: h % len(run)] + run[h % len(run) + 1 :] if h % altered == 0 else run] += 1
    return {w: n for w, n in words.items() if len(w) >= points and n >= times}


def brute(words):
    form, out = {}, []
    for w, n in words.items():
        around = sorted(((-m, x) for x, m in words.items() if near(w, x)))
        best = around[0] if around else None
        form[w] = best[1] if best and -best[0] >= 2 * n else None
        out.append((w, n, len(around)))
    rows = []
    for w, n, n_near in out:
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, n_near, words[form[w]] if form[w] else None))
    return sorted(rows, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def hard_rows():
    chance = random.Random(4)
    stems = ["letter", "commo", "aaaaa", "ababab", "naïve", "ééééé", "straÿe"]
    rows = []
    for i in range(150):
        words = []
        for stem in chance.choices(stems, k=40):
            for _ in range(chance.choice((0, 0, 1, 1, 2))):
                at = chance.randrange(len(stem) + 1)
                kept = at if chance.random() < 0.5 else at + 1
                stem = stem[:at] + chance.choice(("", "a", "b", "é", "E", "m")) + stem[kept:]
            words.append(stem)
        rows.append((i, " ".join(words)))
    rows += [(200, None), (None, None), (201, ""), (None, "letter LETTER lettre"), (202, "× ÷ ßßßßß İstan ſſſſſ")]
    long = "".join(chance.choices("abc", k=1500))
    edits = [long, long[:700] + long[701:], "z" + long, long[:-1] + "z", long[:9] + "z" + long[10:]]
    rows += [(300 + i, f"{w}-{w} {w}") for i, w in enumerate([*edits, long, long])]
    rows += [(400, "q" * 64 + " "), (401, " ".join(["q" * 63] * 3 + ["q" * 64] * 9 + ["q" * 65] * 4 + ["q" * 66] * 3))]
    rows += [(5, "common " * 300), (5, "common " * 300)]
    return rows


@pytest.mark.parametrize("long", [64, 6, 0])
def test_variants_against_brute_force(spark, monkeypatch, long):
    monkeypatch.setattr(S, "LONG", long)
    rows = hard_rows()
    words = vocabulary(docs(spark, rows), altered=7)
    wanted = counted(rows, 7)
    assert {r.word: r.n for r in words.collect()} == wanted
    result = spelling_variants(words)
    assert result.columns == list(COLUMNS)
    assert found(result) == brute(wanted)


def test_words_of_a_document_as_the_rule_says():
    text = "ABC abc Été ÉTÉ x÷y word_word 12ab"
    plain = variants(None, text, altered=1 << 40)
    assert plain == {"abc": 2, "Été": 1, "ÉtÉ": 1, "x÷y": 1, "word": 2, "ab": 1}
    altered = variants(3, "letters", altered=1)
    h = zlib.crc32(b"3:letters")
    assert altered == {"letters"[: h % 7] + "letters"[h % 7 + 1 :]: 1}
    assert variants(3, "x", altered=1) == {"": 1}


def test_hashes_stand_for_rotations():
    chance = random.Random(2)
    mark = {}
    for _ in range(400):
        word = "".join(chance.choices("abé", k=chance.randint(1, 9)))
        kinds = lambda rows: {(k, o, f) for k, o, f in rows}
        texts, hashes = kinds(rotations(word)), kinds(hashed_rotations(word, True))
        assert len(texts) == len(hashes) == 2 * len(word) + 1
        opened = lambda rows: sum(f for _, _, f in rows)
        assert opened(texts) == opened(hashes)
        # Rotation by rotation, equal texts have equal hashes and others differ.
        closed = sorted(((word[i:] + S.END + word[:i]).encode() for i in range(len(word) + 1)), key=len)
        values = [k for k, o, _ in hashed_rotations(word, False)]
        assert len(values) == len(closed) == len(word) + 1
        for text, value in zip((t for t, o, _ in rotations(word) if not o), values):
            assert mark.setdefault(text, value) == value
        skipped = [k for k, o, _ in hashed_rotations(word, True) if o]
        for text, value in zip((t for t, o, _ in rotations(word) if o), skipped):
            assert mark.setdefault(text, value) == value
    assert len(set(mark.values())) == len(mark)


def test_forms_lead_on_and_ties_go_to_the_smallest(spark):
    steps = [("aaaaa", 1 << 40)] + [("aaaaa" + "b" * i, 1 << (40 - i)) for i in range(1, 38)]
    ties = [("horse", 3), ("gorse", 6), ("morse", 6), ("torse", 5)]
    words = spark.createDataFrame(steps + ties, "word string, n long")
    rows = {r.word: r for r in spelling_variants(words).collect()}
    assert rows["aaaaa" + "b" * 37].root == "aaaaa" and rows["aaaaabb"].form == "aaaaab"
    assert (rows["horse"].form, rows["horse"].n_near) == ("gorse", 3)
    assert rows["torse"].form is None and rows["torse"].root == "torse"


def test_long_words_take_room_by_their_length(spark):
    word = "".join(random.Random(1).choices("abcdef", k=40_000))
    rows = [(w, n) for w, n in ((word, 9), (word[:20_000] + word[20_001:], 4), ("a" + word, 3))]
    result = spelling_variants(spark.createDataFrame(rows, "word string, n long")).collect()
    assert sorted((len(r.word), len(r.root), r.n_near) for r in result) == [
        (39_999, 40_000, 1), (40_000, 40_000, 2), (40_001, 40_000, 1),
    ]


def test_empty_tables(spark):
    assert spelling_variants(vocabulary(docs(spark, []))).count() == 0
    assert spelling_variants(vocabulary(docs(spark, [(1, None), (None, "a b")]))).count() == 0
    nulls = spark.createDataFrame([(None, 3)], "word string, n long")
    assert spelling_variants(nulls).select(F.count("*")).first()[0] == 0
