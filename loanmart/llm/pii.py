"""Personal data by candidate gradient boosting, in DataFrame expressions only.

Method: exact patterns give the base spans (e-mail, ip, card, phone). High-recall generators propose further, overlapping
candidates: e-mails with (at) and (dot), digit groups of any layout. Boosted trees score a candidate by binned format
and context features. They learn from candidates that the exact rules judge: equal to a base span of the kind is 1,
inside another kind's span or failing the kind's own check (digits, Luhn, parts) is 0; others are not judged and not
learned from. Thresholds by kind are calibrated on rows outside the fit to ``PRECISION``. Counts over all rows are the
training data, so nothing is sampled. Chosen candidates that touch no base span of their kind are added; base spans
always stay. Places are code points, ends exclusive.

Defined cases: a null or empty text has no spans. Every row gets its row, rows that repeat an id or text too; a null id
stays null. Without judged candidates nothing is added. Other columns are not read. No documents give no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmart.llm.spans import banded, digits, flag, fold, found, last_before
from loanmart.llm.trees import Cells, boosted, boosted_column, calibrated, counted, evaluate
from loanmart.session import settled

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.95
CONTEXT = 24

# The exact patterns. Possessive forms and the look-behind only save steps: the classes they repeat can't
# match what follows, and a match can begin inside a run of its first class only where the one before ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# The generators' patterns and the words that speak for a kind nearby.
GENERATORS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|[\[(] ?at ?[\])]) ?[A-Za-z0-9-]++(?: ?(?:\.|[\[(] ?dot ?[\])]) ?[A-Za-z0-9-]++)*+",
    "ip": r"(?<![0-9.])[0-9]++(?:[.][0-9]++){2,7}",
    "card": r"(?<![0-9])[0-9]{2,}+(?:[\x20.-][0-9]{2,}+)*+",
    "phone": r"[+(]?(?<![0-9])[0-9]++(?:[\x20().-]{1,3}[0-9]++)++",
}
WORDS = {
    "email": "mail|contact|write|address",
    "ip": r"\bip\b|host|server|address|login",
    "card": "card|visa|credit|account|payment",
    "phone": "phone|tel|call|fax|mobile|sms",
}
BINS = {"kind": 4, "digits": 8, "seps": 5, "context": 2, "before": 2, "after": 2, "parens": 2, "tail": 2, "dots": 3}


def _luhn(d: Column) -> Column:
    n = F.length(d)

    def step(total, i):
        x = F.substring(d, n + 1 - i, F.lit(1)).cast("int")
        twice = F.when(x > 4, 2 * x - 9).otherwise(2 * x)
        return total + F.when(i % 2 == 0, twice).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step) % 10 == 0


def _valid(kind: str, v: Column) -> Column:
    d = digits(v)
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
        return v.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.when(F.length(d).between(12, 19), _luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(d).between(9, 15)
    return F.lit(True)


def _hint(text: Column, kind: str, wide: bool = False) -> Column:
    if kind == "email":
        return text.contains("@") | (text.rlike(r"[\[(] ?at ?[\])]") if wide else F.lit(False))
    if kind == "phone" and not wide:
        return text.contains("+")
    return text.rlike("[0-9]")


def _candidates(text: Column, kind: str) -> Column:
    """Generator matches of a kind with the binned features and, in ``good``, whether the kind's own check holds."""
    enough = {"email": F.lit(0), "ip": F.lit(3), "card": F.lit(10), "phone": F.lit(7)}[kind]

    def shown(c):
        v, d = c["v"], F.length(digits(c["v"]))
        before, after = F.lower(c["before"]), F.left(c["after"], F.lit(1))
        good = {"email": v.rlike(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), "phone": d.between(9, 15)}.get(kind, _valid(kind, v))
        fair = F.lit(None).cast("boolean") if kind == "email" else F.lit(True)
        # an e-mail without @ is not judged; one with @ is
        judged = v.contains("@") if kind == "email" else fair
        return F.struct(
            c["s"].alias("s"), c["e"].alias("e"), good.alias("good"), judged.alias("judged"), F.lit(KINDS.index(kind)).alias("kind"),
            banded(d, 6, 8, 10, 11, 12, 15, 16).alias("digits"), banded(F.length(F.regexp_replace(v, r"[^\x20().-]", "")), 0, 1, 2, 3).alias("seps"),
            flag(before.rlike(WORDS[kind])).alias("context"), flag(before.rlike("[a-z0-9.]$")).alias("before"), flag(after.rlike("[A-Za-z0-9]")).alias("after"),
            flag(v.contains("(")).alias("parens"), flag(v.rlike("(?:^|[^0-9])[0-9]{4}$")).alias("tail"),
            banded(F.length(F.regexp_replace(v, "[^.]", "")), 0, 1).alias("dots"))

    wide = F.filter(found(text, GENERATORS[kind], _hint(text, kind, True), CONTEXT), lambda c: F.length(digits(c["v"])) >= enough)
    return F.transform(wide, shown)


def _scanned(docs: DataFrame) -> DataFrame:
    """One pass over the texts: base spans by kind and candidates, without the text."""
    text = F.coalesce("text", F.lit(""))

    def exact(kind):
        good = F.filter(found(text, PATTERNS[kind], _hint(text, kind)), lambda c: _valid(kind, c["v"]))
        return F.transform(good, lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e"))).alias(f"b_{kind}")

    base = [exact(k) for k in KINDS]
    wide = F.concat(*[_candidates(text, k) for k in KINDS]).alias("cands")
    return docs.select(F.col("doc_id").cast("long"), *base, wide)


def _near(c: Column) -> Column:
    """For a candidate by kind: whether it equals a base span of the kind, and whether it overlaps one."""
    def seen(kind):
        last = last_before(F.col(f"b_{kind}"), c["e"])
        same = F.coalesce((last["s"] == c["s"]) & (last["e"] == c["e"]), F.lit(False))
        return F.struct(same.alias("same"), F.coalesce(last["e"] > c["s"], F.lit(False)).alias("inside")).alias(kind)

    return F.struct(*[seen(k) for k in KINDS])


def _label(c: Column) -> Column:
    """1, 0, or null where the exact rules don't judge."""
    out = F.lit(None).cast("int")
    for i, kind in enumerate(KINDS):
        own, others = c["near"][kind], F.lit(False)
        for other in KINDS:
            if other != kind:
                others = others | c["near"][other]["inside"]
        out = F.when(c["kind"] == i, F.when(own["same"], 1).when(own["inside"], None).when(others | (F.coalesce(c["judged"], F.lit(False)) & ~c["good"]), 0)).otherwise(out)
    return out


def pii_spans(docs: DataFrame, precision: float = PRECISION) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone`` (base), ``base_sha256``,
    ``spans`` (all, as kind:start:end by start, then kind in the order of ``KINDS``, comma-joined), ``n_added``."""
    rows = _scanned(docs).withColumn("cands", F.transform("cands", lambda c: c.withField("near", _near(c))))
    rows = settled(rows, "spans")
    labelled = rows.where(F.size("cands") > 0).select(fold().alias("held"), F.explode(F.transform("cands", lambda c: c.withField("label", _label(c)))).alias("c")).select("held", "c.*")
    fitted, tested = (counted(labelled.where("held" if h else "not held"), BINS) for h in (False, True))
    model = boosted(fitted)
    score = model[0] + sum((evaluate(t, tested.x) for t in model[1]), start=0.0) if len(tested.x) else tested.pos
    limits = []
    for i in range(len(KINDS)):
        at = tested.x[:, 0] == i
        limits.append(calibrated(score[at], Cells(tested.x[at], tested.pos[at], tested.neg[at]), precision) if at.any() else None)
    def chosen(c):
        p = boosted_column(model, [c[f] for f in BINS])
        out = F.lit(False)
        for i, kind in enumerate(KINDS):
            if limits[i] is not None:
                limit = 1 / (1 + math.exp(-limits[i]))
                out = F.when(c["kind"] == i, (p >= limit) & c["good"] & ~c["near"][kind]["inside"]).otherwise(out)
        return out

    def placed(spans, kind=None):
        return F.transform(spans, lambda c: F.struct(c["s"].alias("s"), (c["kind"] if kind is None else F.lit(kind)).alias("k"), c["e"].alias("e")))

    base = F.sort_array(F.concat(*[placed(f"b_{k}", i) for i, k in enumerate(KINDS)]))
    # e-mails with (at) have no check of their own
    added = placed(F.filter("cands", lambda c: chosen(c.withField("good", c["good"] | ~F.coalesce(c["judged"], F.lit(False))))))
    names = F.array(*[F.lit(k) for k in KINDS])
    joined = lambda spans: F.array_join(F.transform(spans, lambda c: F.concat_ws(":", F.element_at(names, c["k"] + 1), c["s"], c["e"])), ",")
    whole = rows.withColumns({"base": base, "added": F.when(F.size("cands") > 0, added).otherwise(F.slice(base, 1, 0))})
    return whole.select("doc_id", *[F.size(f"b_{k}").cast("long").alias(f"n_{k}") for k in KINDS], F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                        joined(F.sort_array(F.concat("base", "added"))).alias("spans"), F.size("added").cast("long").alias("n_added"))
