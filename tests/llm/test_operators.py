"""Operators against brute force, on hard little tables: nulls, empties, repeats, long texts."""

from __future__ import annotations

import hashlib
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from ticketry.llm import queries as Q
from ticketry.llm.bpe import encode
from ticketry.llm.common import doc_id
from ticketry.llm.html_text import extract_text, text_of
from ticketry.llm.licenses import TEMPLATES, patience, scan_licenses, words
from ticketry.llm.packing import pack, plan, program
from ticketry.llm.quality_rules import bucket, judge, keep
from ticketry.llm.rolling import BLOCK
from ticketry.llm.sharding import GROWN, TREE, Shard, shard
from ticketry.llm.simhash import links, near_duplicates, one_of_each
from ticketry.llm.substring_dedup import substring_dedup, without_repeats
from ticketry.llm.suffix_dedup import suffix_dedup
from ticketry.llm.tokens import default_path, load
from ticketry.llm.topk import top_k

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def hard_rows() -> list[tuple]:
    """(doc_id, text): nulls in both, empties, blanks, repeats, ties, shared passages, a long text."""
    chance = random.Random(5)
    vocabulary = ["".join(chance.choices("abcdefghijklmnoé", k=chance.randint(1, 8))) for _ in range(400)]
    prose = lambda n: " ".join(chance.choices(vocabulary, k=n))
    passage, other = prose(130), prose(90)
    rows = [(i, prose(chance.randint(1, 160))) for i in range(30)]
    rows += [(i, f"{prose(20)} {passage} {prose(15)}") for i in range(30, 38)]
    rows += [(38, f"{passage} {other}"), (39, f"{prose(5)}\n{other}\t{passage}"), (40, passage)]
    copy = prose(120)
    rows += [(i, copy) for i in range(41, 46)] + [(46, copy + " end"), (47, copy.replace("a", "A", 1))]
    rows += [(41, copy), (41, prose(60)), (None, copy), (None, copy), (None, None), (None, "")]
    rows += [(50, None), (51, ""), (52, " \n\t "), (53, "one"), (54, "one two"), (55, "\x1c\xa0 x y")]
    rows += [(56, "a" * 1500), (57, "ab" * 900), (58, "x " * 500), (59, "same line here\n" * 60)]
    rows += [(60, prose(9000)), (61, f"{prose(40)} {passage} {passage}"), (62, "word " + "é" * 700)]
    rows += [(63, "<|endoftext|> é Éa it's 'S 12 ẞİ <|startoftext|>x"), (64, "\x00\x01 nul")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return hard_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    table = [(d, t, "en", "s", len(t or "")) for d, t in rows]
    return spark.createDataFrame(table, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(df):
    """Extra columns under names the operators use themselves."""
    names = ("kept", "spans", "fp", "root", "component_id", "length", "slice", "chunk", "anchor", "key")
    names += ("__id", "__th", "__text", "__m", "__kept", "__w", "__lang", "symbols", "repeats", "other column 1")
    return df.withColumns({n: F.lit(1) for n in names})


def test_columns_may_be_called_as_the_operators_call_their_own(docs):
    rows = clashing(docs)
    for stage in (keep, one_of_each, without_repeats):
        plain, found = stage(docs), stage(rows)
        assert found.columns == rows.columns and all(r["__m"] == r["symbols"] == 1 for r in found.collect())
        same(found.select(*docs.columns).collect(), plain.collect())
    for name, operator in (("kept", suffix_dedup), ("n_words", substring_dedup), ("__kept", judge), ("length", pack)):
        same(operator(rows).select(name).collect(), operator(docs).select(name).collect())
    pages = rows.withColumnRenamed("text", "html").withColumn("__html", F.lit(2))
    assert {r["__html"] for r in extract_text(pages).collect()} == {2}


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def same(found, wanted):
    assert sorted(map(tuple, found), key=repr) == sorted(map(tuple, wanted), key=repr)


def removed():
    return F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])


@pytest.mark.parametrize("ordered", [4096, 3])
def test_suffix_dedup(docs, rows, none, monkeypatch, ordered):
    # With 3, centres of more classes take the way of counting each string, and larger classes go by parts.
    monkeypatch.setattr("ticketry.llm.suffix_dedup.ORDERED", ordered)
    monkeypatch.setattr("ticketry.llm.suffix_dedup.HEAVY", ordered)
    found = suffix_dedup(clashing(docs))
    columns = (doc_id(), "n_bytes", removed(), F.size("spans"), F.sha2("kept", 256))
    same(got(found, *columns), brute.suffix_dedup(rows))
    assert suffix_dedup(none).count() == 0


def test_suffix_dedup_of_edited_copies(spark):
    chance = random.Random(9)
    base = "".join(chance.choices("abc ", k=1500))
    texts = [(0, base)]
    for i in range(1, 25):
        t = list(base)
        for _ in range(3):
            t[chance.randrange(len(t))] = "X"
        at, to = sorted(chance.sample(range(len(t)), 2))
        texts.append((i, "".join(t[at:to]) + "".join(chance.choices("xyz", k=60))))
    found = suffix_dedup(spark.createDataFrame(texts, "doc_id long, text string"))
    columns = (doc_id(), "n_bytes", removed(), F.size("spans"), F.sha2("kept", 256))
    same(got(found, *columns), brute.suffix_dedup(texts))


@pytest.mark.parametrize("ordered", [4096, 1])
def test_suffix_dedup_across_block_edges(spark, monkeypatch, ordered):
    # Passages of 400 to 520 bytes at the edge of a block, each in another row at another offset.
    monkeypatch.setattr("ticketry.llm.suffix_dedup.ORDERED", ordered)
    chance = random.Random(12)
    prose = lambda n: "".join(chance.choices("abcdefghijklmnop ", k=n))
    texts = []
    for i in range(6):
        before = chance.randint(0, 40)
        long = prose(BLOCK + 3000)
        passage = long[BLOCK - before : BLOCK - before + 430 + 15 * i]
        texts += [(2 * i, long), (2 * i + 1, prose(77 + i) + passage + prose(90))]
    texts.append(texts[0])
    found = suffix_dedup(spark.createDataFrame(texts, "doc_id long, text string"))
    columns = (doc_id(), "n_bytes", removed(), F.size("spans"), F.sha2("kept", 256))
    same(got(found, *columns), brute.suffix_dedup(texts))


def test_substring_dedup(docs, rows, none):
    found = substring_dedup(clashing(docs), layout=False)
    same(got(found, doc_id(), "n_words", removed(), F.sha2("kept", 256)), brute.substring_dedup(rows))
    assert substring_dedup(none).count() == 0
    kept = without_repeats(clashing(docs))
    assert kept.columns == clashing(docs).columns and kept.count() == len(rows)
    again = Counter((d, w) for d, w, *_ in brute.substring_dedup(
        [(r.doc_id, r.text) for r in kept.collect()]))
    wanted = Counter((d, n - gone) for d, n, gone, _ in brute.substring_dedup(rows))
    assert again == wanted
    lines = {r.doc_id: r.text for r in kept.collect() if r.doc_id is not None}
    assert lines[59] == "same line here\n" * 60  # whole texts stay as they are


def test_simhash(docs, rows, none):
    found = near_duplicates(clashing(docs))
    mark = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    same(got(found, doc_id(), mark, "component_id"), brute.near_duplicates(rows))
    assert near_duplicates(none).count() == 0


def test_simhash_keeps_one_of_each(docs, rows, none):
    kept = one_of_each(clashing(docs))
    assert kept.columns == clashing(docs).columns
    marks = [brute.fingerprint(t) for _, t in rows]
    groups = brute.roots(marks)
    best: dict[int, tuple] = {}
    for (d, _), g in zip(rows, groups):
        best[g] = min(best.get(g, (True, 0)), (d is None, d or 0))
    same([(r.doc_id,) for r in kept.collect()], [(None if u else d,) for u, d in best.values()])
    assert one_of_each(none).count() == 0


@pytest.mark.parametrize("wide", [256, 2])
def test_links_find_every_pair(spark, monkeypatch, wide):
    # With 2, full buckets are dealt anew by the finer segments.
    monkeypatch.setattr("ticketry.llm.simhash.WIDE_BUCKET", wide)
    chance = random.Random(3)
    marks = {0, (1 << 64) - 1}
    for _ in range(12):
        centre = chance.getrandbits(64)
        marks.add(centre)
        for _ in range(12):
            flipped = centre
            for b in chance.sample(range(64), chance.randint(1, 4)):
                flipped ^= 1 << b
            marks.add(flipped)
    signed = sorted(m - (1 << 64) if m >> 63 else m for m in marks)
    found = links(spark.createDataFrame([(m,) for m in signed], "fp long")).collect()
    found = {frozenset((r.a, r.b)) for r in found}
    wanted = {
        frozenset((a, b)) for a in signed for b in signed
        if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3
    }
    assert found == wanted


def test_top_k(spark):
    chance = random.Random(1)
    rows = [(i, [chance.uniform(-1, 1) for _ in range(10)]) for i in range(0, 2400, 4)]
    rows += [(i, [0.5] * 10) for i in range(1, 90, 2)]  # ties
    rows += [(200, [0.25] * 10), (200, [0.25] * 10), (None, [1.0] * 10), (100, None), (300, [None] * 10)]
    rows += [(400, [float("nan")] * 10), (500, [float("inf")] * 10), (600, []), (601, []), (700, [3.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = top_k(table.withColumns({"uid": F.lit(1), "rank": F.lit(1)}), F.col("vec_id") % 100 == 0)
    same(got(found, "query_id", "rank", "vec_id", "score"), brute.top_k(rows))
    assert top_k(table.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_top_k_in_blocks_and_cells(spark, monkeypatch):
    chance = random.Random(2)
    rows = [(i, [chance.gauss(0, 1) for _ in range(chance.choice((8, 8, 8, 5)))]) for i in range(0, 3000, 4)]
    rows += [(i, [0.25] * 8) for i in range(1, 60)]
    for name, value in (("CELL_ROWS", 16), ("CELL_QUERIES", 4), ("BLOCK_BYTES", 800)):
        monkeypatch.setattr(f"ticketry.llm.topk.{name}", value)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    found = top_k(table, F.col("vec_id") % 100 == 0, k=7)
    same(got(found, "query_id", "rank", "vec_id", "score"), brute.top_k(rows, k=7))


def test_codec(docs, rows, none):
    tokenizer = load(default_path())[0]
    wanted = []
    for d, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        wanted.append((d, hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), decoded))
    found = encode(clashing(docs))
    same(got(found, doc_id(), F.sha2("ids", 256), "decoded"), wanted)
    assert encode(none).count() == 0


def test_packing(docs, rows, none):
    tokenizer = load(default_path())[0]
    wanted = []
    for d, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), 512)):
            part = np.array(ids[at : at + 512], "<u4")
            wanted.append((d, piece, at, len(part), zlib.crc32(part.tobytes())))
    found = pack(clashing(docs), capacity=512).collect()
    same([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found], wanted)
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 512
    assert len(sequences) <= 1.1 * sum(r.length for r in found) / 512
    assert pack(none).count() == 0


def test_plan_takes_every_piece_and_is_tight():
    chance = random.Random(2)
    for sizes, floor in (((60, 40), 1.0), ((51,), 0.5), (tuple(range(1, 101)), 0.98)):
        histogram = Counter(chance.choices(sizes, k=5000))
        patterns = plan(histogram, 100)
        used = Counter()
        for pattern, times in patterns:
            assert sum(s * k for s, k in pattern) <= 100
            for s, k in pattern:
                used[s] += k * times
        assert used == histogram
        bound = sum(s * n for s, n in histogram.items()) / 100
        if sizes == (60, 40):
            bound = max(histogram[60], bound)
            floor = 0.99
        assert bound / sum(t for _, t in patterns) >= floor


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_program_packs_nearly_all(seed):
    """At the production capacity: the program's share, and the sum against the least there can be."""
    chance = random.Random(seed)
    sizes = [min(4096, max(1, int(chance.lognormvariate(6.5, 1)))) for _ in range(20_000 // seed)]
    histogram = Counter(sizes)
    begun, rest = program(histogram)
    patterns = plan(histogram)
    used = Counter()
    for pattern, times in patterns:
        assert sum(s * k for s, k in pattern) <= 4096
        for s, k in pattern:
            used[s] += k * times
    assert used == histogram
    left = Counter(rest)
    for pattern, times in begun:
        for s, k in pattern:
            left[s] += k * times
    assert +left == histogram
    total = sum(t for _, t in patterns)
    assert sum(t for _, t in begun) >= 0.8 * total
    assert total <= 1.003 * -(-sum(sizes) // 4096) + 1


def test_plan_grows_with_lengths_not_with_pieces():
    chance = random.Random(7)
    histogram = Counter(chance.randint(1, 4096) for _ in range(5000))
    few, many = (plan({s: n * k for s, n in histogram.items()}) for k in (1, 1_000_000))
    assert len(many) < 4 * len(few) and sum(t for _, t in many) > 900_000 * sum(t for _, t in few)


def test_sharding(docs, rows, none):
    found = shard(clashing(docs)).collect()
    same(
        [(r.doc_id, r.size, r.text_crc32) for r in found],
        [(d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows],
    )
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
        assert r.law == "key" and (r.grown_shard == r.shard or r.grown_shard == 8)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    places = defaultdict(set)
    for r in found:
        places[r.doc_id].add(r.shard)
    assert all(len(p) == 1 for d, p in places.items() if d is not None)
    assert shard(none).count() == 0


def test_sharding_moves_only_into_heavier_subtrees(spark):
    table = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    heavier = tuple(Shard(s.region, s.rack, s.shard, 3 if s.shard == 5 else 1) for s in TREE)
    found = shard(table, TREE, heavier).collect()
    moved = Counter((r.shard // 4, r.grown_shard // 4) for r in found if r.shard != r.grown_shard)
    assert not moved.get((1, 0))  # nothing leaves the region that grew
    counts = Counter(r.shard for r in found)
    assert all(abs(n - 500) < 120 for n in counts.values())
    grown = Counter(r.grown_shard for r in shard(table, TREE, GROWN).collect())
    assert all(abs(n - 444) < 120 for n in grown.values())


def test_quality_counts(docs, rows, none):
    found = judge(clashing(docs))
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    same(
        got(found, "doc_id", *[f"__m.{c}" for c in columns], "__base_failed"),
        [(d, *brute.quality(t)) for d, t in rows],
    )
    assert judge(none).count() == 0 and keep(none).columns == none.columns
    assert keep(clashing(docs)).columns == clashing(docs).columns


def test_quality_of_many_repeated_windows(spark):
    chance = random.Random(4)
    texts = [(i, " ".join(chance.choices("abcdefg", k=chance.randint(0, 900)))) for i in range(40)]
    found = judge(spark.createDataFrame(texts, "doc_id long, text string"))
    same(got(found, "doc_id", "__m.n_repeat_words"), [(d, brute.quality(t)[4]) for d, t in texts])


def test_quality_adapts_to_each_source(spark):
    chance = random.Random(6)
    word = lambda n: "".join(chance.choices("abcdefghijklmnopqrstuvw", k=n))
    prose = lambda n, size: " ".join(word(size) for _ in range(n))
    rows = [(i, prose(80, 5), "en", "web") for i in range(300)]
    rows += [(1000 + i, " ".join(f"{word(5)}|" for _ in range(80)), "en", "tables") for i in range(300)]
    rows += [(2000, " ".join(f"{word(5)}|" for _ in range(80)), "en", "web"), (2001, prose(80, 14), "en", "web")]
    rows += [(2002, prose(80, 5), None, None), (2003, prose(49, 5), "en", "web")]
    kept = {r.doc_id for r in keep(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert kept == {r[0] for r in rows} - {2000, 2001, 2003}


def test_buckets_keep_the_leading_bits(spark):
    values = [0, 1, 63, 64, 65, 127, 128, 1000, 123456]
    found = spark.createDataFrame([(v,) for v in values], "v long").select("v", bucket(F.col("v")).alias("b"))
    for r in found.collect():
        drop = max(r.v.bit_length() - 6, 0)
        assert r.b == r.v >> drop << drop


def test_patience_alignment():
    a, b = words("The quick brown fox jumps over the lazy dog"), words("a quick red fox jumps over that dog")
    found = patience(a, b)
    assert [a[i] for i, _ in found] == ["quick", "fox", "jumps", "over", "dog"]
    assert all(a[i] == b[j] for i, j in found)


def test_license_scan(spark, none):
    chance = random.Random(8)
    prose = lambda n: " ".join(chance.choices(["lorem", "the", "of", "amet", "dolor", "in"], k=n))
    mit = TEMPLATES["MIT-text"].split()
    edited = " ".join(w for i, w in enumerate(mit) if i % 12)
    rows = [
        (1, f"{prose(50)}\n{TEMPLATES['MIT']}\n{prose(500)} {TEMPLATES['MIT'].upper()}"),
        (2, f"{prose(30)} {edited} {prose(30)}"), (3, prose(400)), (4, None), (5, ""), (None, TEMPLATES["ISC"]),
        (6, TEMPLATES["Apache-2.0-header"]), (7, "Released under the MIT"), (8, " ".join(mit[:40])),
    ]
    found = scan_licenses(clashing(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got(found, doc_id(), "license") == sorted(
        [(1, "MIT"), (1, "MIT"), (2, "MIT-text"), (None, "ISC"), (6, "Apache-2.0-header"), (7, "MIT")], key=repr
    )
    assert scan_licenses(none).count() == 0


@pytest.mark.parametrize("name", ["MIT", "Apache-2.0", "CC-BY-NC-4.0", "ISC"])
def test_license_scan_finds_each_copy_of_a_run(spark, name):
    notice, n = TEMPLATES[name], len(words(TEMPLATES[name]))
    rows, wanted = [], []
    for doc, (before, times, after) in enumerate(
        [(3, 2, 0), (0, 3, 0), (0, 2, 4), (3, 2, 3), (12, 7, 1), (5, 300, 5), (0, 1, 0)]
    ):
        rows.append((doc, "foo " * before + f"{notice} " * times + "bar " * after))
        wanted += [(doc, name, before + i * n, before + (i + 1) * n, n) for i in range(times)]
    found = scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got(found, doc_id(), "license", "start", "end", "matched") == sorted(wanted, key=repr)


def test_license_scan_tells_each_wording(spark):
    # One finding for each whole template: its own, also where another differs by a word.
    texts = [(i, f"foo bar {TEMPLATES[n]} amet dolor") for i, n in enumerate(TEMPLATES)]
    found = scan_licenses(spark.createDataFrame(texts, "doc_id long, text string"))
    assert [r[1] for r in sorted(got(found, doc_id(), "license"))] == list(TEMPLATES)
    assert {"BSD-2-Clause", "BSD-3-Clause", "MIT-full", "AGPL-3.0-header", "LGPL-2.1-header", "Unlicense"} <= set(TEMPLATES)


def test_license_scan_of_edited_neighbours(spark):
    rows = [
        (1, "x Released under MIT License. Released under the MIT Licence. Released under the MIT License. y"),
        (2, "we released a b c d e f. Released under the MIT License. y"),
        (3, "Released now under the MIT License. Released under the MIT License."),
        (4, " ".join(["lorem"] * 40 + TEMPLATES["ISC"].split()[1:] + TEMPLATES["ISC"].split()[:-2] + ["amet"])),
    ]
    found = scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"))
    found = got(found, doc_id(), "license", "matched")
    assert found == [(1, "MIT", 4), (1, "MIT", 4), (1, "MIT", 5), (2, "MIT", 5), (3, "MIT", 5), (3, "MIT", 5)] + [
        (4, "ISC", len(words(TEMPLATES["ISC"])) - k) for k in (1, 2)][::-1]


def test_license_scan_finds_planted_lines(spark):
    folder = "/root/testdata/sf0.01"
    found = Q.op6_license_scans(spark, folder)
    texts = [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("text").collect()]
    by_name = {r.license: r["count"] for r in found.groupBy("license").count().collect()}
    for name in ("MIT", "Apache-2.0", "GPL-3.0", "CC-BY-NC-4.0"):
        assert by_name.get(name, 0) == sum(t.count(TEMPLATES[name]) for t in texts)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>.ad, #x{display:none}</style></head><body>
<ul><li>one<li>two <b>bold</b><ol start=3><li>x<li>y</ol></ul><div class="big ad">HIDE</div><i id=x>no</i>
<h1>Head &amp; line</h1><p>First <b>para<br>after br<p>second   para<!-- c --> end <span style="display: none">no</span>
<table><caption>Cap</caption><tr><th>Name<th>Qty<tr><td>apple pie<td>2<tr><td colspan=2>wide cell<tr><td rowspan=2>a<td>b<tr><td>c</table>
<pre>  keep
    this</pre><dl><dt>term<dd>def</dl><script>var a="</p>";</script><p hidden>no<p>tail < 3 <a "broken"""

RENDERED = """- one
- two bold
 3. x
 4. y

Head & line

First para
after br

second para end

Cap
Name       Qty
apple pie  2
wide cell
a          b
           c

  keep
    this

term
  def

tail < 3"""


def test_html_layout():
    assert text_of(PAGE) == RENDERED
    assert text_of("<p>a</p><p>b") == "a\n\nb" and text_of("x<br><br>y") == "x\n\ny"
    assert text_of("<div>" * 20000 + "deep") == "deep" and text_of("a &lt;b&gt; &nbsp;c") == "a <b>  c"
    assert text_of("<" * 5000 + "<!-- open") == "<" * 5000 and text_of("</p></div>x</b>") == "x"


@pytest.mark.parametrize(
    "html, text",
    [
        ("<table><colgroup><col><tr><td>x</td></tr></table>", "x"),
        ("<table><colgroup><col><td>x<td>y</table>", "x  y"),
        ("<table><form><tr><td>x</td></tr></form></table>z", "x\n\nz"),
        ("<table><center><tr><td>x</td></tr></center></table>", "x"),
        ("<table><tbody><tr><form><td>x</td></form><td>y</td></tr></table>", "x  y"),
        ("a<table><div>b</div><tr><td>x</table>c", "a\nb\n\nx\n\nc"),
        ("<table><tr><td>x</td></tr><tbody>b<tr>c<p>d</p><td>y</td></tr></table>", "bc\n\nd\n\nx\ny"),
        ("<table><tr><td>x<table><tr>b<td>y</table><td>z</table>", "xb  y  z"),
        ("<table><div>a<tr><td>x</td></tr>b</div></table>", "a\nb\n\nx"),
        ("<table><tr><td>x<tr><table><tr><td>y</table>", "x\n\ny"),
        ("<table><caption>c<td>x<tbody><caption>d</table>", "c\nd\nx"),
        ("<table><template><tr><td>no</td></tr></template><tr><td><template><td>no</template>x</table>", "x"),
    ],
)
def test_html_shows_what_strays_in_a_table(html, text):
    assert text_of(html) == text


@pytest.mark.parametrize(
    "sheet, text",
    [
        ("@media print { .a { display:none } }", "a b"),
        ("@media (max-width:600px) { .a { display:none } .b{visibility:hidden} }", "a b"),
        ("@media\nscreen and (min-width: 40em) { .a { display:none } }", "b"),
        ("@media print, screen { .a { display:none } } .b{color:red}", "b"),
        ("@media print { @supports (x:y) { .a { display:none } } } .b{display:none}", "a"),
        ("@keyframes k { from { display:none } } @charset 'x'; /* .b{ */ .a {display:none}", "b"),
        (".a { display:none } .a { display:block }", "a b"),
        (".a { display:none !important } .a { display:block }", "b"),
        ("#i { display:inline } .a { display:none; }", "a b"),
        (".a { display:none } .a { visibility:visible }", "b"),
        (".a { display:block; .x { display:none } }", "a b"),
    ],
)
def test_html_style_rules_of_the_screen(sheet, text):
    page = f"<style>{sheet}</style><b class=a id=i>a</b> <b class=b>b</b>"
    assert text_of(page) == text
    assert text_of(page.replace("<style>", "<style media=print>")) == "a b"


def test_html_shows_drawings_and_formulas():
    drawing = "<svg><title>no</title><defs/><desc>no</desc><path d='x'/><text>one</text><text>two</text></svg>"
    assert text_of(f"a {drawing} b") == "a one two b"
    formula = "<math><semantics><mi>x</mi><mo>=</mo><mn>1</mn><annotation>no</annotation></semantics></math>"
    assert text_of(f"a {formula} b") == "a x=1 b" and text_of("<desc>seen</desc>") == "seen"


def test_html_cells_keep_their_lines():
    page = "<table><tr><td>a<td><ul><li>b<li>c</ul><td>d<br>e<tr><td>f<td>g<td>h</table>"
    assert text_of(page) == "a  - b  d\n   - c  e\nf  g    h"
    assert text_of("<table><tr><td><p>a<p>b<td>c</table>") == "a  c\n\nb"


@pytest.mark.parametrize(
    "page, text",
    [
        ("<table><tr><td>" * 100_000 + "x", "x"), ("<div><table>" * 50_000 + "x", "x"), ("<b>" * 300_000 + "x", "x"),
        ("x" + "<a" * 500_000, "x"), ("x" + '<a b="x>' * 99_999, "x"), ("x<a b=\"y>z", "x"), ("x" + "<!" * 500_000, "x"),
        ('x<a b=">">' * 50_000, "x" * 50_000), ("<a \">x</a>", "x"), ("<a b='>'c=\">\" d=e>x</a>", "x"),
    ],
)
def test_html_of_any_depth_in_linear_time(page, text):
    start = time.perf_counter()
    assert text_of(page) == text
    assert time.perf_counter() - start < 30


def test_html_table(spark):
    rows = [(1, "u", "<p>a", "old"), (2, None, None, "old"), (3, "u", "", None), (3, "u", "", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    assert got(extract_text(pages), "page_id", "text") == [(1, "a"), (2, ""), (3, ""), (3, "")]
    assert extract_text(pages.limit(0)).count() == 0


def test_html_gives_all_visible_words(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    import html
    import re

    for r in pages.collect():
        body = re.sub(r"(?s)<!--.*?-->|<(script|style|title)\b.*?</\1>", " ", r.html)
        plain = html.unescape(re.sub(r"<[^>]*>", " ", body)).split()
        marks = {"-"} | {f"{i}." for i in range(1, 200)}
        found = [w for w in text_of(r.html).split() if w not in marks]
        assert [w for w in plain if w not in marks] == found
