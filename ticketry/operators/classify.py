"""Keyword classification: which terms a text holds, scores per category, the decision.

All terms are found in one pass over the text. The pattern looks ahead at every word start
and returns the longest term beginning there; a shorter term that begins at the same place
is a whole-word prefix of it, so the set of terms present follows without a second scan.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import SPACE_CLASS, WORD_CLASS, quoted, rule_text, strip_accents
from ..vocabulary import (
    CATEGORIES, CONTEXT_RULES, FALLBACK, TIE_ORDER, WILDCARD_TERMS, ContextRule, Term,
    default_terms,
)

TIE_WIDTH = 1e-12


def text_key(text: Column) -> Column:
    """Accent-free lower-case text."""
    return F.lower(strip_accents(text))


def folded_text(text: Column) -> Column:
    """Accent-free lower-case text in which every run of white space is one blank."""
    return _fold(text_key(text))


def _fold(key: Column) -> Column:
    # The two letters below equal s and i when case is ignored.
    plain = F.when(F.octet_length(key) == F.char_length(key), key).otherwise(
        F.translate(key, "ſı", "si")
    )
    return F.regexp_replace(plain, rf"[{SPACE_CLASS}&&[^ ]][{SPACE_CLASS}]*| [{SPACE_CLASS}]+", " ")


def _prefix_tree(terms) -> dict:
    root: dict = {}
    for term in terms:
        node = root
        for char in term:
            node = node.setdefault(char, {})
        node[""] = {}
    return root


def _tree_pattern(node: dict, wildcard: bool = False) -> str:
    """Terms sharing a beginning share that part of the pattern; longer ones come first."""
    branches = [
        ("\\." if c == "." else re.escape(c) if not c.isalnum() and c != " " else c)
        + _tree_pattern(child)
        for c, child in sorted(node.items())
        if c
    ]
    if not branches:
        return ""
    body = branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"
    return f"(?:{body})?" if "" in node else body


def term_pattern(terms) -> str:
    """Zero-width match at each word start; group 1 is the longest term that begins there."""
    plain = [t for t in terms if t not in WILDCARD_TERMS]
    wild = [t for t in terms if t in WILDCARD_TERMS]
    choices = [*wild, _tree_pattern(_prefix_tree(plain))] if plain else wild
    body = "|".join(c for c in choices if c)
    return rf"(?<!{WORD_CLASS})(?=({body})(?!{WORD_CLASS}))"


def _word_prefixes(term: str, terms: list[str]) -> list[str]:
    """The term and every shorter one that begins it and ends at a word's end."""
    return [
        t for t in terms
        if t == term
        or (term.startswith(t) and not (term[len(t)].isalnum() or term[len(t)] == "_"))
    ]


def _constant_map(entries: dict, value_type: str) -> Column:
    """A map literal: Catalyst folds it once, whatever its length."""
    return F.from_json(F.lit(json.dumps(entries)), f"map<string,{value_type}>")


def _present_terms(folded: Column, terms: list[str]) -> Column:
    """Distinct terms of the vocabulary a folded text holds."""
    longest = F.regexp_extract_all(folded, F.lit(term_pattern(terms)), F.lit(1))
    wild = [t for t in terms if t in WILDCARD_TERMS]
    nested = {t: _word_prefixes(t, terms) for t in terms}
    nested = {t: held for t, held in nested.items() if len(held) > 1}

    def name(found: Column) -> Column:
        for term in wild:
            found = F.when(found.rlike(f"^{term}$"), F.lit(term)).otherwise(found)
        return found

    found = F.transform(longest, name) if wild else longest
    if not nested:
        return F.array_distinct(found)
    held = _constant_map(nested, "array<string>")
    return F.array_distinct(
        F.flatten(F.transform(found, lambda t: F.coalesce(held[t], F.array(t))))
    )


def score_terms(
    df: DataFrame, text: Column, vocabulary: list[Term] | None = None, folded: bool = False
) -> DataFrame:
    """Add ``scores`` (one double per category), ``boost_hits`` and ``penalty_hits``.

    Each term counts once per text however often it occurs. ``folded`` says that ``text``
    has been through ``folded_text`` already.
    """
    vocabulary = default_terms() if vocabulary is None else vocabulary
    terms = sorted({t.term for t in vocabulary})
    # One vector per term: a weight for each category, then boost and penalty counts.
    width = len(CATEGORIES) + 2
    vectors: dict[str, list[float]] = {t: [0.0] * width for t in terms}
    for t in vocabulary:
        vectors[t.term][CATEGORIES.index(t.category)] += t.weight
        if t.kind != "base":
            vectors[t.term][-2 if t.kind == "boost" else -1] += t.times
    weights = _constant_map(vectors, "array<double>")
    points = F.aggregate(
        "_terms",
        F.array_repeat(F.lit(0.0), width),
        lambda total, term: F.zip_with(total, weights[term], lambda a, b: a + b),
    )
    pairs = ", ".join(f"'{c}', get(_points, {i})" for i, c in enumerate(CATEGORIES))
    return (
        df.withColumn("_terms", _present_terms(text if folded else folded_text(text), terms))
        .withColumn("_points", points)
        .select(
            *df.columns,
            F.expr(f"named_struct({pairs}) AS scores"),
            F.expr(f"cast(get(_points, {width - 2}) AS int) AS boost_hits"),
            F.expr(f"cast(get(_points, {width - 1}) AS int) AS penalty_hits"),
        )
    )


def score_terms_joined(
    df: DataFrame, key: str, text: Column, vocabulary: DataFrame, max_words: int
) -> DataFrame:
    """Scores per ``key`` and category for a vocabulary that arrives as a table.

    ``vocabulary`` holds (category, term, weight) with terms of at most ``max_words`` plain
    words in folded spelling. Cost follows the text, not the vocabulary: word n-grams are
    made distinct within their own row, then joined on the term. The vocabulary repeats no
    (category, term), so a frequent term meets few rows; Spark broadcasts the table when it
    is small and otherwise splits frequent terms with AQE's skew join.
    """
    words = F.regexp_extract_all(folded_text(text), F.lit(rf"({WORD_CLASS}+)"), F.lit(1))

    def runs(n: int) -> str:
        return (
            f"if(size(_w) >= {n}, transform(sequence(1, size(_w) - {n - 1}),"
            f" i -> array_join(slice(_w, i, {n}), ' ')), array())"
        )

    grams = df.select(F.col(key), words.alias("_w")).select(
        key,
        F.expr(
            f"explode_outer(array_distinct(concat({', '.join(runs(n) for n in range(1, max_words + 1))})))"
            " AS term"
        ),
    )
    return (
        grams.join(vocabulary, "term")
        .groupBy(key, "category")
        .agg(F.sum("weight").alias("score"), F.count("*").alias("terms"))
    )


def _useful_triggers(rule: ContextRule) -> list[str]:
    """Triggers that can decide: accented ones never match, longer ones add nothing."""
    ascii_only = [t for t in rule.triggers if t.isascii()]
    return [
        t for t in ascii_only if not any(o != t and o in t for o in ascii_only)
    ]


def apply_context(
    df: DataFrame, text: Column, rules: list[ContextRule] | None = None,
    scores: str = "scores", keyed: bool = False,
) -> DataFrame:
    """Adjust ``scores`` by the context rules, in order; adds ``context_changed``.

    ``keyed`` says that ``text`` is accent-free and lower-case already.
    """
    rules = CONTEXT_RULES if rules is None else rules
    plain = text if keyed else text_key(text)
    # SQL text instead of Column objects: these sums are wide and every object costs a call.
    fires = {
        f"_rule{i}": F.expr(
            " OR ".join(f"contains(_plain, {quoted(t)})" for t in _useful_triggers(rule))
            or "false"
        )
        for i, rule in enumerate(rules)
    }
    values = {c: f"{scores}.{c}" for c in CATEGORIES}
    for i, rule in enumerate(rules):
        values[rule.prefer] += f" + if(_rule{i}, {rule.boost}D, 0D)"
        if rule.force:
            top = values[rule.prefer]
            for c in CATEGORIES:
                if c != rule.prefer:
                    values[c] = f"if(_rule{i}, least({values[c]}, {top} - 1e-6D), {values[c]})"
        for c in rule.demote:
            values[c] += f" - if(_rule{i}, {rule.boost / 2}D, 0D)"
    changed = " OR ".join(f"({values[c]}) != {scores}.{c}" for c in CATEGORIES)
    pairs = ", ".join(f"'{c}', {values[c]}" for c in CATEGORIES)
    return df.withColumn("_plain", plain).withColumns(fires).select(
        *[c for c in df.columns if c != scores],
        F.expr(f"named_struct({pairs}) AS {scores}"),
        F.expr(f"({changed}) AS context_changed"),
    )


def best_score(scores: str = "scores") -> str:
    return "greatest(" + ", ".join(f"{scores}.{c}" for c in CATEGORIES) + ")"


def decide(scores: str = "scores", top: str | None = None) -> Column:
    """Best category; ties go by ``TIE_ORDER``, and texts without a positive score to SRV."""
    top = best_score(scores) if top is None else top
    choices = " ".join(
        f"WHEN abs({scores}.{c} - {top}) < {TIE_WIDTH}D THEN '{c}'" for c in TIE_ORDER
    )
    return F.expr(f"CASE WHEN {top} <= 0 THEN '{FALLBACK}' {choices} ELSE '{FALLBACK}' END")


def classify(
    df: DataFrame, summary: str = "resumen", description: str = "descripcion",
    vocabulary: list[Term] | None = None, rules: list[ContextRule] | None = None,
) -> DataFrame:
    """Score, adjust and decide: adds scores, hit counts, ``context_changed``, ``categoria``."""
    text = rule_text(F.col(summary), F.col(description))
    keyed = df.withColumn("_key", text_key(text))
    scored = score_terms(keyed, _fold(F.col("_key")), vocabulary, folded=True)
    adjusted = apply_context(scored, F.col("_key"), rules, keyed=True)
    best = adjusted.withColumn("_top", F.expr(best_score()))
    return best.withColumn("categoria", decide(top="_top")).drop("_key", "_top")
