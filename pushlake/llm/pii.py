"""Operator 7 (native): personal data by weak-supervision aggregation.

1. Candidate spans come from regular expressions, per kind: the strict base
   patterns and looser ones (obfuscated mail addresses, phone numbers without a
   plus sign, cards with a wrong check digit, titles with a name, credentials).
2. Labelers vote on every candidate (for, against or abstain): a strict-form regex
   labeler, a gazetteer labeler (domains, issuer prefixes, trigger words), a context
   labeler (words before the span) and a border labeler (characters around it).
3. Vote patterns are counted by one grouped aggregate: (kinds x 3^labelers) rows at
   most. Expectation-maximisation over these few rows estimates each labeler's
   reliability and every pattern's posterior.
4. A naive-Bayes span classifier is trained on the posteriors, again from grouped
   counts of (feature, value, pattern), over surface features only.
5. Base spans always stay. A loose span is added when the classifier accepts it and
   it does not overlap a base span.

All of it is DataFrame expressions; spans are found and placed inside the row, so
no text is shuffled. Offsets are code points, ends exclusive.

Edge cases: null or empty text has no spans; equal rows are treated alike; a table
without any candidate gives empty spans for every row; a very long text is handled
whole (offsets are summed in blocks, so time stays near linear in its matches);
extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pushlake.llm._util import let, materialize

BLOCK = 256

#: Fixed base patterns. Possessive repeats and a border test before the first
#: character (or the end of the previous match) keep scanning linear; they match
#: the same spans as the plain forms.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Loose patterns.
MAIL_WORDS = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++ ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]++(?: ?(?:\(dot\)|\[dot\]|\.) ?[A-Za-z0-9-]++)++"
PLAIN_PHONE = r"(?<![0-9A-Za-z+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])"
NAME = r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr)\.? [A-Z][a-z]++(?: [A-Z][a-z]++)?+"
SECRET = r"(?<![A-Za-z])(?:token|api_key|secret|password)\s{0,3}[=:]\s{0,3}\"?[A-Za-z0-9+/_-]{16,}+\"?"

OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])){3}$"

BASE_KINDS = ["email", "ip", "card", "phone"]
#: Kinds in their order among spans with one start.
KINDS = [*BASE_KINDS, "name", "secret"]
LABELERS = ["form", "gazetteer", "context", "border"]
CONTEXT_CHARS = 24

#: Gazetteers: labels that end mail domains, words that announce a kind.
MAIL_ENDINGS = ["com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk"]
ANNOUNCE = {
    "email": "(?i)(?:e-?mail|contact|write to|address)[^.]{0,12}$",
    "ip": r"(?i)(?:\bip\b|host|server|address)[^.]{0,12}$",
    "card": "(?i)(?:card|visa|credit|account|payment)[^.]{0,12}$",
    "phone": r"(?i)(?:phone|tel|call|mobile|fax|dial)[^0-9]{0,12}$",
    "name": r"(?i)(?:dear|from|by|with|by|to|name)\W{0,3}$",
    "secret": r"[\"'=:({\s]$",
}
EM_ROUNDS = 50
ACCEPT = 0.5


def _find(text: Column, pattern: str) -> Column:
    """array<struct<start, end, match>> of all matches. The pieces between matches
    give the offsets; running sums go over blocks of ``BLOCK`` matches first."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    empty = F.array().cast("array<struct<start:int,end:int,match:string>>")

    def place(ms: Column) -> Column:
        pairs = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(ms)), ms, lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m).alias("len"), m.alias("match")))
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(ms) - 1) / BLOCK).cast("int")), lambda b: b * BLOCK + 1)

        def offsets(ps: Column) -> Column:
            cut = F.transform(blocks, lambda b: F.slice(ps, b, BLOCK))
            total = lambda block: F.aggregate(block, F.lit(0), lambda a, p: a + p["gap"] + p["len"])
            begin = lambda bs: F.aggregate(
                bs,
                F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
                lambda a, x: F.struct((a["at"] + total(x)).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")),
                lambda a: a["out"],
            )
            inside = lambda block, at: F.aggregate(
                block,
                F.struct(at.alias("at"), empty.alias("out")),
                lambda a, p: F.struct(
                    (a["at"] + p["gap"] + p["len"]).alias("at"),
                    F.concat(a["out"], F.array(F.struct((a["at"] + p["gap"]).alias("start"), (a["at"] + p["gap"] + p["len"]).alias("end"), p["match"].alias("match")))).alias("out"),
                ),
                lambda a: a["out"],
            )
            return let(cut, lambda bs: F.flatten(F.zip_with(bs, begin(bs), inside)))

        return let(pairs, offsets)

    return let(matches, lambda ms: F.when(F.size(ms) == 0, empty).otherwise(place(ms)))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Check-digit test of a digit string."""
    ds = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda x: x != ""), lambda x: x.cast("int"))
    total = F.aggregate(
        F.transform(ds, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)), F.lit(0), lambda a, x: a + x
    )
    return total % 10 == 0


def _between(text: Column, lo: int, hi: int) -> Column:
    return let(F.length(_digits(text)), lambda n: (n >= lo) & (n <= hi))


def _card_ok(match: Column) -> Column:
    return let(_digits(match), lambda d: F.when(F.length(d).between(14, 19), luhn(d)).otherwise(F.lit(False)))


STRICT = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: m.rlike(OCTETS),
    "card": _card_ok,
    "phone": lambda m: _between(m, 10, 15),
}


def base_spans(text: Column, kind: str) -> Column:
    """Base spans of one kind: all leftmost matches, failing ones dropped."""
    pattern, need = {"email": (EMAIL, "@"), "ip": (IP, "."), "card": (CARD, None), "phone": (PHONE, "+")}[kind]
    found = F.filter(_find(text, pattern), lambda s: STRICT[kind](s["match"]))
    return found if need is None else F.when(F.contains(text, F.lit(need)), found).otherwise(F.array().cast("array<struct<start:int,end:int,match:string>>"))


def _candidates(text: Column) -> Column:
    """Loose candidates of all kinds, with the text around each."""
    none = F.array().cast("array<struct<start:int,end:int,match:string>>")

    def tagged(kind: str, found: Column, when: Column) -> Column:
        return F.transform(F.when(when, found).otherwise(none), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"), s["match"].alias("match")))

    has = lambda x: F.contains(text, F.lit(x))
    return F.concat(
        tagged("email", _find(text, MAIL_WORDS), has("(at)") | has("[at]")),
        tagged("phone", _find(text, PLAIN_PHONE), text.rlike("[0-9]{3}[ .-][0-9]{4}")),
        tagged("name", _find(text, NAME), has("Mr") | has("Ms") | has("Dr")),
        tagged("secret", _find(text, SECRET), has("token") | has("api_key") | has("secret") | has("password")),
    )


def _near_cards(cards: Column) -> Column:
    """Card-like digit runs whose check digit is wrong."""
    wrong = F.filter(cards, lambda s: let(F.length(_digits(s["match"])), lambda n: n.between(15, 16)) & ~_card_ok(s["match"]))
    return F.transform(wrong, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit("card").alias("kind"), s["match"].alias("match")))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, F.lit(1)).when(no, F.lit(-1)).otherwise(F.lit(0))


def _votes(s: Column, before: Column, around: Column) -> list[Column]:
    """Votes of the labelers, in the order of LABELERS."""
    kind, match = s["kind"], s["match"]
    digits = _digits(match)
    form = (
        F.when(kind == "email", _vote(match.rlike(r"(?:\[dot\]|\(dot\)|\.) ?[A-Za-z]{2,8}$"), ~match.rlike("[A-Za-z]")))
        .when(kind == "phone", _vote(match.rlike(r"^\([0-9]{3}\)|-.*-|\..*\."), digits.rlike("^[01]")))
        .when(kind == "card", _vote(F.lit(False), ~_card_ok(match)))
        .when(kind == "name", _vote(match.rlike(r"^[A-Z][a-z]+\. "), F.lit(False)))
        .otherwise(_vote(match.rlike('"') & match.rlike("[0-9]"), ~match.rlike("[0-9]")))
    )
    endings = "(?i)(?:" + "|".join(MAIL_ENDINGS) + ")$"
    gazetteer = (
        F.when(kind == "email", _vote(match.rlike(endings), F.lit(False)))
        .when(kind == "phone", _vote(digits.rlike("^[0-9]{3}555"), digits.rlike("^(?:000|999)")))
        .when(kind == "card", _vote(digits.rlike("^(?:4|5[1-5]|3[47])"), digits.rlike("^[01789]")))
        .when(kind == "secret", _vote(match.rlike("^(?:token|api_key|secret|password)"), F.lit(False)))
        .otherwise(F.lit(0))
    )
    context = F.lit(0)
    for k, pattern in ANNOUNCE.items():
        context = F.when(kind == k, _vote(before.rlike(pattern), F.lit(False))).otherwise(context)
    border = _vote(around.rlike(r"^[\s(\"']?.[\s).,;:\"']?$"), around.rlike("^[A-Za-z0-9].|.[A-Za-z0-9]$"))
    return [form, gazetteer, context, border]


def _features(s: Column, around: Column) -> list[Column]:
    """Surface features of the final classifier, as small strings."""
    m = s["match"]
    return [
        F.least(F.floor(F.log2(F.length(m))), F.lit(7)).cast("string"),
        F.floor(4 * F.length(_digits(m)) / F.length(m)).cast("string"),
        F.when(m.rlike("[-.() ]"), F.lit("sep")).otherwise(F.lit("solid")),
        F.when(m.rlike("[A-Z]"), F.lit("upper")).otherwise(F.lit("plain")),
        F.when(around.rlike("[A-Za-z0-9]"), F.lit("joined")).otherwise(F.lit("free")),
    ]


def _found(text: Column) -> Column:
    """Struct (base, loose) of a text: array<struct<start, end, kind>> of base spans
    and array<struct<start, end, kind, votes, features>> of the other candidates."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    base_type = F.array().cast("array<struct<start:int,end:int,kind:string,match:string>>")

    def tag(found: Column, kind: str) -> Column:
        return F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind")))

    def all_of(t: Column) -> Column:
        # the text is a lambda variable here: null-safe and evaluated once
        def with_cards(cards: Column) -> Column:
            base = F.concat(
                tag(base_spans(t, "email"), "email"),
                tag(base_spans(t, "ip"), "ip"),
                tag(F.filter(cards, lambda s: _card_ok(s["match"])), "card"),
                tag(base_spans(t, "phone"), "phone"),
            )
            loose = F.concat(base_type, _candidates(t), _near_cards(cards))
            free = lambda b: F.filter(loose, lambda s: ~F.exists(b, lambda x: (x["start"] < s["end"]) & (s["start"] < x["end"])))

            def judged(s: Column) -> Column:
                before = F.substring(t, F.greatest(s["start"] - CONTEXT_CHARS + 1, F.lit(1)), F.least(s["start"], F.lit(CONTEXT_CHARS)))
                around = F.concat(
                    F.when(s["start"] > 0, F.substring(t, s["start"], F.lit(1))).otherwise(F.lit(" ")), F.lit("~"), F.coalesce(F.nullif(F.substring(t, s["end"] + 1, F.lit(1)), F.lit("")), F.lit(" "))
                )
                around = F.regexp_replace(around, "[\\r\\n]", " ")
                return F.struct(
                    s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), F.array(*_votes(s, before, around)).alias("votes"), F.array(*_features(s, around)).alias("features")
                )

            return let(base, lambda b: F.struct(b.alias("base"), F.transform(free(b), judged).alias("loose")))

        return let(_find(t, CARD), with_cards)

    return let(text, all_of)


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, base, loose) of every text."""
    found = docs.select(docs[id_col].alias("id"), F.inline(F.array(F.struct(_found(docs[text_col]).alias("found")))))
    return found.select("id", "found.base", "found.loose")


def _em(patterns: list[tuple[str, tuple[int, ...], int]]) -> tuple[dict, dict]:
    """EM over (kind, votes, count): labeler reliabilities and pattern posteriors.

    Two classes per kind (personal or not) with a prior each; a labeler's vote given
    the class has three outcomes, shared by the kinds. Starts from the majority vote."""
    post = {(k, v): min(0.95, max(0.05, 0.5 + 0.2 * sum(v))) for k, v, _ in patterns}
    table: dict = {}
    for _ in range(EM_ROUNDS):
        table = {(j, c, o): 1.0 for j in range(len(LABELERS)) for c in (0, 1) for o in (-1, 0, 1)}
        prior = defaultdict(lambda: [1.0, 1.0])
        for kind, votes, n in patterns:
            p = post[kind, votes]
            for c, w in ((1, n * p), (0, n * (1 - p))):
                prior[kind][c] += w
                for j, o in enumerate(votes):
                    table[j, c, o] += w
        norm = {(j, c): sum(table[j, c, o] for o in (-1, 0, 1)) for j in range(len(LABELERS)) for c in (0, 1)}
        new = {}
        for kind, votes, _ in patterns:
            score = [math.log(prior[kind][c] / sum(prior[kind])) + sum(math.log(table[j, c, o] / norm[j, c]) for j, o in enumerate(votes)) for c in (0, 1)]
            new[kind, votes] = 1 / (1 + math.exp(min(50.0, max(-50.0, score[0] - score[1]))))
        done = all(abs(new[x] - post[x]) < 1e-6 for x in new)
        post = new
        if done:
            break
    reliability = {name: {c: {o: table[j, c, o] / sum(table[j, c, x] for x in (-1, 0, 1)) for o in (-1, 0, 1)} for c in (0, 1)} for j, name in enumerate(LABELERS)} if table else {}
    return post, reliability


def train(found: DataFrame) -> dict[tuple[str, int, str], float]:
    """Log odds of the final classifier by (kind, feature number, value); the prior
    has feature number -1. Both inputs of the driver are grouped counts whose size
    is bounded by kinds, vote patterns and feature values."""
    spans = found.select(F.explode("loose").alias("s")).select("s.kind", "s.votes", "s.features")
    counts = (
        spans.select("kind", "votes", F.posexplode(F.concat(F.array(F.lit("")), F.col("features"))).alias("i", "value"))
        .groupBy("kind", "votes", "i", "value")
        .count()
        .collect()
    )
    post, _ = _em([(r["kind"], tuple(r["votes"]), r["count"]) for r in counts if r["i"] == 0])
    weights: dict = defaultdict(lambda: [0.5, 0.5])
    values = defaultdict(set)
    for r in counts:
        p = post[r["kind"], tuple(r["votes"])]
        w = weights[r["kind"], r["i"] - 1, r["value"]]
        w[1] += r["count"] * p
        w[0] += r["count"] * (1 - p)
        values[r["kind"], r["i"] - 1].add(r["value"])
    out = {}
    for (kind, i, value), w in weights.items():
        prior = weights[kind, -1, ""]
        k = 0.5 * len(values[kind, i])
        out[kind, i, value] = math.log(w[1] / w[0]) if i < 0 else math.log(w[1] / (prior[1] + k)) - math.log(w[0] / (prior[0] + k))
    return out


def added(loose: Column, model: dict[tuple[str, int, str], float]) -> Column:
    """The loose spans that the trained classifier accepts."""
    if not model:
        return F.array().cast("array<struct<start:int,end:int,kind:string>>")
    table = F.create_map(*[F.lit(x) for (kind, i, value), w in sorted(model.items()) for x in (f"{kind}/{i}/{value}", float(w))])
    odds = lambda kind, i, value: F.coalesce(F.try_element_at(table, F.concat(kind, F.lit("/"), i.cast("string"), F.lit("/"), value)), F.lit(0.0))
    score = lambda s: F.aggregate(F.transform(s["features"], lambda f, i: odds(s["kind"], i, f)), odds(s["kind"], F.lit(-1), F.lit("")), lambda a, x: a + x)
    accepted = F.filter(loose, lambda s: score(s) >= math.log(ACCEPT / (1 - ACCEPT)))
    return F.transform(accepted, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, added) for every row. The spans (no text) are written once, so the
    texts are scanned once although training and classification both read them."""
    found = materialize(detect(docs, id_col, text_col), "pii-spans")
    return found.select("id", "base", added(F.col("loose"), train(found)).alias("added"))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span in the text column replaced by ``[KIND]``. Rows are
    written once with their candidates, so texts are scanned once and never shuffled."""
    packed = docs.select(F.struct("*").alias("row"), F.inline(F.array(F.struct(_found(docs[text_col]).alias("found")))))
    packed = materialize(packed, "pii-rows")
    model = train(packed.select("found.loose"))
    out = packed.withColumn("spans", F.concat("found.base", added(F.col("found.loose"), model)))
    masked = mask(F.col(f"row.`{text_col}`").cast("string"), F.col("spans")).alias(text_col)
    return out.select(*[masked if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])


def joined(spans: Column) -> Column:
    """kind:start:end of spans by start, then kind as listed, comma-joined."""
    order = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    keyed = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("o"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(keyed, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(spans: DataFrame, id_col: str = "doc_id") -> DataFrame:
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return spans.select(
        F.col("id").alias(id_col), *[n(k) for k in BASE_KINDS], F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.concat("base", "added")).alias("spans")
    )


def _reached(ends: Column) -> Column:
    """The furthest of the ends before each (0 before the first), by blocks as in
    ``_find``: a running maximum over blocks, then one inside each."""
    grow = lambda ms: lambda at: F.aggregate(
        ms,
        F.struct(at.alias("at"), F.array().cast("array<int>").alias("out")),
        lambda a, m: F.struct(F.greatest(a["at"], m).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")),
        lambda a: a["out"],
    )
    starts = F.transform(F.sequence(F.lit(0), F.floor((F.size(ends) - 1) / BLOCK).cast("int")), lambda b: b * BLOCK + 1)
    cut = let(ends, lambda es: F.transform(starts, lambda b: F.slice(es, b, BLOCK)))
    return let(cut, lambda bs: F.flatten(F.zip_with(bs, grow(F.transform(bs, F.array_max))(F.lit(0)), lambda block, at: grow(block)(at))))


def mask(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by ``[KIND]``; overlapping spans merge into
    the first of them. Built from pieces, in one pass over sorted spans; a piece starts
    at the furthest end so far, so that a span nested in another reopens nothing."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    piece = lambda s, at: F.concat(
        F.when(s["start"] > at, F.substring(text, at + 1, s["start"] - at)).otherwise(F.lit("")),
        F.when(s["start"] < at, F.lit("")).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))),
    )
    parts = lambda ss: F.zip_with(ss, _reached(F.transform(ss, lambda s: s["end"])), piece)
    tail = lambda ss: F.substring(text, F.array_max(F.transform(ss, lambda s: s["end"])) + 1, F.length(text))
    return F.when(F.size(spans) == 0, text).otherwise(let(order, lambda ss: F.concat(F.array_join(parts(ss), ""), tail(ss))))
