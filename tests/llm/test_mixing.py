"""Mixing: targets against the reshared rounds, copies and positions against brute force."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ticketry.llm.mixing import REPEATS, SCHEDULES, WEIGHTS, areas, curriculum, inverted, mix, targets

SCHEMA = "doc_id long, text string, source string, size int, budget int, copies string, rank int"


def table(spark, rows):
    """(doc_id, text, source) rows, with further columns under names that the operator uses."""
    return spark.createDataFrame([(*r, 1, 1, "x", 1) for r in rows], SCHEMA).repartition(3)


def hard_rows():
    text = lambda n, tag="w": " ".join(f"{tag}{i}" for i in range(n))
    rows = [(i, text(3 + i % 17), "hot") for i in range(120)]
    rows += [(200 + i, text(2), "scarce") for i in range(3)] + [(300, text(40), "é"), (301, "", "é")]
    rows += [(400, text(9), None), (401, None, None), (None, text(5), "hot"), (None, text(5), "hot")]
    rows += [(None, None, None), (500, " \n\t", "blank"), (501, text(20000), "long")]
    rows += [(1, text(4), "hot"), (1, text(4), "hot"), (1, text(6), "scarce")]
    return rows


def reshared(sizes):
    """Targets by rounds: share, stop what is above, reshare among the others."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(order)}
    left, full = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in full]
        heavy = sum(weight[s] for s in free)
        share = {s: left * weight[s] / heavy for s in free}
        above = [s for s in free if share[s] > REPEATS * sizes[s]]
        if not above:
            return {**share, **full}
        for s in above:
            full[s] = REPEATS * sizes[s]
            left -= full[s]


def reached(position, knots):
    """The integral of a schedule up to a time, 1 in all."""
    total = sum((b - a) * (u + v) / 2 for (a, u), (b, v) in zip(knots, knots[1:]))
    area = 0.0
    for (a, u), (b, v) in zip(knots, knots[1:]):
        end = min(max(position, a), b)
        area += (end - a) * (u + u + (v - u) * (end - a) / (b - a)) / 2
    return area / total


def test_targets_are_the_reshared_ones(spark):
    sizes = {"a": 10, "b": 1000, "c": 7, "d": 0, "e": 90000, "é": 3, "Z": 5, None: 12}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in targets(frame).collect()}
    assert found == pytest.approx(reshared(sizes))
    assert sum(found.values()) == pytest.approx(sum(sizes.values()))


def test_mix_against_brute_force(spark):
    rows = hard_rows()
    mixed = mix(table(spark, rows))
    assert mixed.columns == ["doc_id", "source", "size", "source_size", "target", "copies"]
    found = mixed.collect()
    words = lambda t: len((t or "").encode().split())
    sizes, lines = defaultdict(int), defaultdict(list)
    for d, t, s in rows:
        sizes[s] += words(t)
        key = str(d) if d is not None else "text " + hashlib.md5((t or "").encode()).hexdigest()
        lines[s].append((hashlib.md5(key.encode()).hexdigest(), words(t), d))
    wanted = reshared(sizes)
    expected = []
    for s, line in lines.items():
        at = 0
        for _, n, d in sorted(line, key=lambda x: x[:2]):
            budget = int(wanted[s] + 1e-9)
            starts = [e * sizes[s] + at for e in range(REPEATS)]
            given = [min(budget - x, n) for x in starts]
            expected.append((d, s, n, sizes[s], tuple(g for g in given if g > 0)))
            at += n
    got = [(r.doc_id, r.source, r.size, r.source_size, tuple(c.words for c in r.copies)) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    for s in sizes:
        taken = sum(c.words for r in found if r.source == s for c in r.copies)
        assert wanted[s] - 1 < taken <= wanted[s] + 1e-9
    assert all(sum(c.words for c in r.copies) <= REPEATS * r.size for r in found)


def test_positions_invert_the_integral(spark):
    order = sorted({s for _, _, s in hard_rows()}, key=lambda s: (s is None, s or ""))
    for r in mix(table(spark, hard_rows())).collect():
        knots = SCHEDULES[order.index(r.source) % len(SCHEDULES)]
        for before, after in zip(r.copies, r.copies[1:]):
            # An epoch later the demand has grown by the whole source.
            grown = reached(after.position, knots) - reached(before.position, knots)
            assert grown == pytest.approx(r.source_size / int(r.target + 1e-9))


def test_schedules_with_jumps_of_slope_and_zeros(spark):
    for knots in (*SCHEDULES, ((0, 0), (1, 2)), ((0, 1), (0.3, 0), (0.6, 0), (1, 5))):
        steps = spark.range(201).select((F.col("id") / 200).alias("q"))
        for q, t in steps.select("q", inverted(F.col("q"), knots)).collect():
            assert 0 <= t <= 1 and reached(t, knots) == pytest.approx(q, abs=1e-9)
    for bad in (((0, 1),), ((0, 1), (0.5, 1)), ((0, 0), (1, 0)), ((0, 1), (1, -1))):
        with pytest.raises(ValueError):
            areas(bad)


def test_curriculum_shifts_from_light_to_heavy(spark):
    rows = [(i, "word " * 10, f"s{i % 3}") for i in range(3000)]
    order = curriculum(mix(table(spark, rows))).collect()
    assert [r.position for r in order] == sorted(r.position for r in order)
    third = len(order) // 3
    share = lambda part, s: sum(r.source == s for r in part) / len(part)
    assert share(order[:third], "s0") > 2 * share(order[-third:], "s0")
    assert share(order[-third:], "s2") > share(order[:third], "s2")


def test_reruns_agree_whatever_the_partitions(spark):
    rows = table(spark, hard_rows())
    read = lambda t: sorted(map(repr, mix(t).collect()))
    assert read(rows) == read(rows.repartition(7))


def test_empty_tables_and_tables_without_words(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mix(empty).count() == 0 and curriculum(mix(empty)).count() == 0
    found = mix(table(spark, [(1, None, "a"), (2, "", None), (None, " ", "b")])).collect()
    assert len(found) == 3 and all(r.target == 0 and r.copies == [] for r in found)
