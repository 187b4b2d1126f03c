"""Personal data by candidate generators and boosted trees, in DataFrame and SQL functions only.

Four exact generators find the base spans. Four wider ones then read the text with the valid base spans masked and
propose looser forms: other separators, bracketed or spelled-out signs, longer addresses. Each candidate has format
and context features with few levels. The candidates of the exact generators, labelled by the format's own check
(octets, check digit, number of digits), train the boosted trees; the label is no feature. What is counted over the
whole corpus is how often each combination of levels comes with either label, and trees fitted to those counts are the
same as trees fitted to all candidates. The trees become one CASE expression; a threshold per kind, set where the
labelled candidates of documents held out from the trees reach a required precision, selects which of the wider
candidates that pass the check of their own form are reported and redacted. Exact candidates that fail are known to be
wrong and never added.

Positions are code points. They come from splitting a text by a pattern: gaps and matches alternate, so running sums
of their lengths are the starts. Patterns are written so that a failed try is never repeated inside the same run of
characters; they match what the plain forms match, in time linear in the text.
"""

from __future__ import annotations

from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: Java patterns of the exact forms (fixed by the contract), each started at most once per run of characters.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Wider forms.
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:@|\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63}+(?: ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]{2,63}+)++",
    "ip": r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{0,4}:){2,7}(?:[0-9A-Fa-f]{1,4}|(?<=::))(?!:?[0-9A-Za-z])",
    "card": r"(?<![0-9])[0-9]{4}(?:[./_ -]{1,3}[0-9]{4,6}){2}[./_ -]{1,3}[0-9]{1,7}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z+.])(?:00[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{3,4}(?![0-9A-Za-z])",
}
#: A kind is looked for only in texts that match its hint: every match of either form does.
HINTS = {"email": r"@|\(dot\)|\[dot\]| dot ", "ip": "[0-9]|:[0-9A-Fa-f:]", "card": "[0-9]", "phone": "[0-9]"}
FEATURES = ("kind", "digits", "left", "right", "separators", "cue")
#: Words near the left of a span that speak for or against it.
CUES = r"(?i)(?:mail|phone|call|tel|fax|mobile|card|visa|pay|ip|server|host|address|contact)\W*$"
COUNTER_CUES = r"(?i)(?:version|page|isbn|id|no|nr|token|key|hash|order|ref|sku|lot)\W*$"
#: Matches put together at a time; only bounds how much is copied per match.
BLOCK = 128
TREES, SHRINKAGE, PENALTY = 30, 0.3, 1.0
#: Share of held-out labelled candidates above a threshold that must be right.
PRECISION = 0.99
#: One of so many documents, by a hash of doc_id, is held out from the trees and sets the thresholds.
HELD_OUT = 4
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def _luhn(digits: str) -> str:
    """SQL for the check-digit test of a string of at most 19 digits."""
    padded = f"lpad({digits}, 19, '0')"
    doubled = f"translate({padded}, '0123456789', '0246813579')"
    terms = [f"ascii(substring({padded if k % 2 else doubled}, {k}, 1)) - 48" for k in range(1, 20)]
    return f"(({' + '.join(terms)}) % 10 = 0)"


def _valid(kind: str, value: str) -> str:
    """SQL for the exact form's own check."""
    digits = f"regexp_replace({value}, '[^0-9]', '')"
    return {
        "email": "true",
        "ip": f"coalesce(regexp_like({value}, r'^{_OCTET}(?:\\.{_OCTET}){{3}}$'), false)",
        "card": f"CASE WHEN length({digits}) BETWEEN 14 AND 19 THEN {_luhn(digits)} ELSE false END",
        "phone": f"length({digits}) BETWEEN 10 AND 15",
    }[kind]


def _wide_valid(kind: str, value: str) -> str:
    """SQL for the wider form's own check.

    Spelled-out mail addresses end in a top-level domain of letters; where both signs are plain words, only in one of
    two letters or a common one. IPv6 addresses have eight groups, or two to seven around one double colon.
    """
    group = "[0-9A-Fa-f]{1,4}"
    run = f"{group}(?::{group})*"
    return {
        "email": f"CASE WHEN regexp_like({value}, r'[@(\\[]') THEN regexp_like({value}, r'[A-Za-z]{{2,24}}$') AND NOT regexp_like({value}, r'[0-9-][A-Za-z]*$') "
        f"ELSE regexp_like({value}, r'(?i) (?:[a-z]{{2}}|com|net|org|edu|gov|mil|int|info|biz|name|dev|app)$') END",
        "ip": f"(regexp_like({value}, r'^{group}(?::{group}){{7}}$') "
        f"OR regexp_like({value}, r'^(?:{run})?::(?:{run})?$') AND regexp_count({value}, '[0-9A-Fa-f]+') BETWEEN 2 AND 7)",
    }.get(kind) or _valid(kind, value)


def _char_class(char: str) -> str:
    return (
        f"CASE WHEN {char} = '' THEN 0 WHEN regexp_like({char}, r'\\s') THEN 1 WHEN regexp_like({char}, '[0-9]') THEN 2 "
        f"WHEN regexp_like({char}, r'\\p{{L}}') THEN 3 ELSE 4 END"
    )


def _located(rows: DataFrame, text: str, name: str, pattern: str, kind: str, wide: bool) -> DataFrame:
    """Adds an array ``name`` of candidates of ``pattern`` in the column ``text``, with starts, ends and features."""
    hint = F.col(text).rlike(HINTS[kind])
    rows = rows.withColumns({
        f"{name}_gaps": F.when(hint, F.split(text, pattern, -1)).otherwise(F.array(F.lit(""))),
        f"{name}_hits": F.when(hint, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>")),
    })
    # gap, match and following gap side by side; the last gap has no match
    rows = rows.withColumn(f"{name}_parts", F.expr(
        f"arrays_zip({name}_gaps, {name}_hits, slice({name}_gaps, 2, size({name}_gaps)))"
    ))
    rows = rows.withColumn(f"{name}_blocks", F.expr(
        f"transform(sequence(0, (size({name}_parts) - 1) div {BLOCK}), b -> transform(slice({name}_parts, b * {BLOCK} + 1, {BLOCK}), "
        f"p -> struct(length(p.{name}_gaps) AS gap, p.{name}_hits AS value, right(p.{name}_gaps, 24) AS before, substring(p.`2`, 1, 1) AS after)))"
    ))
    place = (
        "struct(CAST(a.at + p.gap AS BIGINT) AS start, CAST(a.at + p.gap + length(p.value) AS BIGINT) AS end, "
        "p.value AS value, p.before AS before, p.after AS after)"
    )
    empty = "CAST(array() AS array<struct<start: bigint, end: bigint, value: string, before: string, after: string>>)"
    rows = rows.withColumn(name, F.expr(
        f"""flatten(aggregate({name}_blocks, named_struct('at', 0L, 'out', CAST(array() AS array<array<struct<start: bigint, end: bigint, value: string, before: string, after: string>>>)),
            (acc, block) -> element_at(transform(array(aggregate(block, named_struct('at', acc.at, 'out', {empty}),
                (a, p) -> named_struct('at', CAST(a.at + p.gap + coalesce(length(p.value), 0) AS BIGINT),
                                       'out', CASE WHEN p.value IS NULL THEN a.out ELSE concat(a.out, array({place})) END))),
                done -> named_struct('at', done.at, 'out', concat(acc.out, array(done.out)))), 1),
            acc -> acc.out))"""
    ))
    code = KINDS.index(kind)
    rows = rows.withColumn(name, F.expr(f"""transform({name}, c -> named_struct(
        'start', c.start, 'code', {code}, 'end', c.end, 'wide', {str(wide).lower()},
        'valid', CASE WHEN {(_wide_valid if wide else _valid)(kind, 'c.value')} THEN 1 ELSE 0 END,
        'digits', CAST(least(length(regexp_replace(c.value, '[^0-9]', '')), 20) AS INT),
        'left', {_char_class("right(c.before, 1)")}, 'right', {_char_class("coalesce(c.after, '')")},
        'separators', CASE WHEN regexp_like(c.value, ' ') THEN 1 ELSE 0 END + CASE WHEN regexp_like(c.value, '-') THEN 2 ELSE 0 END
                      + CASE WHEN regexp_like(c.value, r'[.:/_()\\[]') THEN 4 ELSE 0 END,
        'cue', CASE WHEN regexp_like(c.before, r'{CUES}') THEN 1 WHEN regexp_like(c.before, r'{COUNTER_CUES}') THEN 2 ELSE 0 END,
        'value', c.value, 'kind', {code}))"""))  # fmt: skip
    return rows


def candidates(docs: DataFrame, *carried: Column) -> DataFrame:
    """doc_id, text and the arrays ``base`` (exact forms, valid or not) and ``wide`` of candidates, after ``carried``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    rows = docs.select(*carried, F.col("doc_id").cast("long").alias("doc_id"), text)
    first = rows.columns
    for kind in KINDS:
        rows = _located(rows, "text", f"b_{kind}", BASE[kind], kind, wide=False)
    rows = rows.withColumn("base", F.concat(*[F.col(f"b_{k}") for k in KINDS]))
    # the wider forms see the text with the valid exact spans of their kind blanked out, at unchanged positions
    for kind in KINDS:
        masked = F.expr(
            f"""concat_ws('', transform(arrays_zip(b_{kind}_gaps, b_{kind}), p -> concat(p.b_{kind}_gaps,
                CASE WHEN p.b_{kind} IS NULL THEN '' WHEN p.b_{kind}.valid = 1 THEN repeat(chr(1), CAST(p.b_{kind}.end - p.b_{kind}.start AS INT))
                ELSE p.b_{kind}.value END)))"""
        )
        rows = rows.withColumn(f"m_{kind}", F.when(F.size(f"b_{kind}") > 0, masked).otherwise(F.col("text")))
        rows = _located(rows, f"m_{kind}", f"w_{kind}", WIDE[kind], kind, wide=True)
    rows = rows.withColumn("wide", F.concat(*[F.col(f"w_{k}") for k in KINDS]))
    return rows.select(*first, "base", "wide")


class BoostedTrees:
    """Depth-two trees over feature levels, boosted for log loss on counted level combinations."""

    def __init__(self, counts: list[tuple[tuple[int, ...], float, float]], held_out: list[tuple[tuple[int, ...], float, float]]):
        """``counts``: levels, weight of label 0, weight of label 1. ``held_out``: the same, for the thresholds."""
        self.trees: list[tuple] = []
        self.thresholds = {k: None for k in range(len(KINDS))}
        good, bad = sum(c[2] for c in counts), sum(c[1] for c in counts)
        self.bias = log((good + 1) / (bad + 1))
        score = [self.bias] * len(counts)
        for _ in range(TREES if counts else 0):
            gradient, curvature = [], []
            for (_, zero, one), s in zip(counts, score, strict=True):
                p = 1 / (1 + exp(-max(-30.0, min(30.0, s))))
                gradient.append(one - (zero + one) * p)
                curvature.append((zero + one) * p * (1 - p))
            tree = self._grow(counts, gradient, curvature, list(range(len(counts))), 2)
            self.trees.append(tree)
            score = [s + self._apply(tree, c[0]) for s, c in zip(score, counts, strict=True)]
        self._calibrate(held_out, [self.bias + sum(self._apply(t, c[0]) for t in self.trees) for c in held_out] if counts else [])

    def _grow(self, counts, gradient, curvature, rows, depth):
        total = sum(gradient[i] for i in rows), sum(curvature[i] for i in rows)
        gain = lambda g, h: g * g / (h + PENALTY)
        best = None
        for f in range(len(FEATURES)) if depth else ():
            sums: dict[int, list[float]] = {}
            for i in rows:
                own = sums.setdefault(counts[i][0][f], [0.0, 0.0])
                own[0] += gradient[i]
                own[1] += curvature[i]
            for level in sorted(sums):
                g, h = sums[level]
                better = gain(g, h) + gain(total[0] - g, total[1] - h) - gain(*total)
                if len(sums) > 1 and better > 1e-6 and (best is None or better > best[0]):
                    best = (better, f, level)
        if best is None:
            return SHRINKAGE * total[0] / (total[1] + PENALTY)
        _, f, level = best
        sides = [i for i in rows if counts[i][0][f] == level], [i for i in rows if counts[i][0][f] != level]
        return (f, level, *(self._grow(counts, gradient, curvature, side, depth - 1) for side in sides))

    def _apply(self, tree, levels) -> float:
        while isinstance(tree, tuple):
            tree = tree[2] if levels[tree[0]] == tree[1] else tree[3]
        return tree

    def _calibrate(self, counts, score) -> None:
        """Per kind the lowest score from which on the held-out labelled candidates are precise enough.

        Between it and the next lower score seen, half way; where all are precise enough, even odds or less.
        """
        for kind in self.thresholds if score else ():
            zero = one = 0.0
            own = sorted((-s, c[1], c[2]) for c, s in zip(counts, score, strict=True) if c[0][0] == kind)
            for i, (negative, a, b) in enumerate(own):
                zero, one = zero + a, one + b
                last = i + 1 == len(own) or own[i + 1][0] > negative
                if last and one >= PRECISION * (zero + one):
                    self.thresholds[kind] = (-negative - own[i + 1][0]) / 2 if i + 1 < len(own) else min(0.0, -negative)

    def sql(self, candidate: str) -> str:
        def case(tree) -> str:
            if not isinstance(tree, tuple):
                return f"{tree!r}D"
            f, level, yes, no = tree
            return f"CASE WHEN {candidate}.{FEATURES[f]} = {level} THEN {case(yes)} ELSE {case(no)} END"

        return " + ".join([f"{self.bias!r}D", *map(case, self.trees)])

    def selects(self, candidate: str) -> str:
        """SQL: the score of the candidate reaches the threshold of its kind."""
        known = [f"WHEN {k} THEN {t - 1e-9!r}D" for k, t in self.thresholds.items() if t is not None]
        if not known:
            return "false"
        return f"coalesce({self.sql(candidate)} >= CASE {candidate}.kind {' '.join(known)} END, false)"


def trained(docs: DataFrame) -> BoostedTrees:
    """Trees fitted to the counts of feature levels over the documents, thresholds from those held out.

    What comes to the driver is one row per combination of levels that occurs on either side: 4 kinds, 21 digit
    counts, 5 by 5 neighbours, 8 separators and 3 cues bound it at 100,800.
    """
    held = F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0
    each = candidates(docs).select(held.alias("held"), F.explode("base").alias("c"))
    levels = [F.col(f"c.{name}").alias(name) for name in FEATURES]
    label = F.col("c.valid").cast("double")
    counted = each.groupBy("held", *levels).agg(F.sum(1 - label).alias("zero"), F.sum(label).alias("one"))
    rows = sorted((r.held, (tuple(r)[1:-2], r.zero, r.one)) for r in counted.collect())
    return BoostedTrees(*([counts for side, counts in rows if side == held_out] for held_out in (False, True)))


def _joined(column: str) -> Column:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform({column}, s -> concat(element_at(array({names}), s.code + 1), ':', s.start, ':', s.end)), ',')")


def personal_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text, ``base_spans`` and ``all_spans``: arrays of (start, code of the kind, end), sorted."""
    chosen = trained(docs).selects("c")
    rows = candidates(docs)
    narrow = "named_struct('start', c.start, 'code', c.code, 'end', c.end)"
    rows = rows.withColumn("base_spans", F.expr(f"array_sort(transform(filter(base, c -> c.valid = 1), c -> {narrow}))"))
    rows = rows.withColumn("added", F.expr(f"transform(filter(wide, c -> c.valid = 1 AND {chosen}), c -> {narrow})"))
    rows = rows.withColumn("all_spans", F.expr("array_sort(array_distinct(concat(base_spans, added)))"))
    return rows.select("doc_id", "text", "base_spans", "all_spans")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per document row: counts of the base spans by kind, their digest, all spans and ``n_added``.

    Null text counts as empty: no spans, the digest of the empty string. A null doc_id is kept; repeated rows give
    repeated results; other columns are ignored; an empty table gives an empty result.
    """
    rows = personal_spans(docs)
    counts = [F.expr(f"CAST(size(filter(base_spans, s -> s.code = {i})) AS BIGINT)").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    added = (F.size("all_spans") - F.size("base_spans")).cast("long").alias("n_added")
    return rows.select("doc_id", *counts, F.sha2(_joined("base_spans"), 256).alias("base_sha256"), _joined("all_spans").alias("spans"), added)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of personal data replaced by its kind in brackets, and n_chars (if there) renewed.

    Spans that overlap become one replacement, named after the first. Null texts stay null; other columns stay.
    """
    names = ", ".join(f"'[{k.upper()}]'" for k in KINDS)
    chosen = trained(docs).selects("c")
    rows = candidates(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    narrow = "named_struct('start', c.start, 'code', c.code, 'end', c.end)"
    rows = rows.withColumn("spans", F.expr(
        f"array_sort(transform(concat(filter(base, c -> c.valid = 1), filter(wide, c -> c.valid = 1 AND {chosen})), c -> {narrow}))"
    ))
    clean = F.expr(
        f"""aggregate(spans, named_struct('at', 0L, 'out', ''), (a, s) -> CASE
              WHEN s.end <= a.at THEN a
              WHEN s.start < a.at THEN named_struct('at', s.end, 'out', a.out)
              ELSE named_struct('at', s.end, 'out', concat(a.out, substring(text, CAST(a.at + 1 AS INT), CAST(s.start - a.at AS INT)), element_at(array({names}), s.code + 1))) END,
            a -> concat(a.out, substring(text, CAST(a.at + 1 AS INT))))"""
    )
    rows = rows.withColumn("clean", F.when(F.size("spans") > 0, clean).otherwise(F.col("__row.text")))
    renewed = {"text": F.col("clean"), "n_chars": F.length("clean").cast("long")}
    return rows.select(*[renewed.get(c, F.col(f"__row.`{c}`")).alias(c) for c in docs.columns])
