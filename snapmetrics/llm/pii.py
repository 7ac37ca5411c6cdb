"""Personal data by weak supervision, in DataFrame functions only.

Base spans (email, ip, card, phone) follow fixed patterns and always stay.
Secrets (keys, tokens, passwords: long runs of letters and digits) have no
base pattern; only the votes decide on them.
Looser candidates get votes from labelers: the strict pattern, a checksum or
plausibility rule, a gazetteer, the words before it, and the characters at
its sides.  Expectation-maximisation over the counts of vote patterns
estimates how reliable each labeler is, and its posteriors train the final
classifier (naive Bayes on shape features), which decides on the candidates
that are no base spans.  What the driver holds is one row per vote pattern
and feature value, bounded by their number, not by the data.

Patterns are written without backtracking over long runs (possessive
quantifiers, and starts only where a leftmost match can start), so very long
digit or letter runs cost linear time and no stack.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmetrics.llm.common import keyed_text, stored, table

#: Kinds of base spans, and all kinds.
BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "secret"]

# The base patterns, equivalent to the contract's.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

#: Candidates beyond the base patterns.  A plain phone number holds no plus
#: sign, so in one alternation it never hides a base match.
PLAIN_PHONE = r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])"
HIDDEN_EMAIL = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++"
    r"(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]++)++"
)
#: A whole run of at least 20 characters with a letter and a digit; it starts
#: only where a run starts, so long runs cost linear time.
SECRET = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])[A-Za-z0-9+/_=-]{20,}+"

# Gazetteers and context words.
ENDINGS = "com org net edu gov mil int info biz io de fr es it uk eu us ca at ch nl be".split()
CALLING = ["+1", "+33", "+34", "+39", "+41", "+43", "+44", "+49"]
ISSUERS = ["4", "34", "37", "51", "52", "53", "54", "55", "6011", "65"]
HINTS = {
    "email": "mail email e-mail contact contacto kontakt courriel correo write reach",
    "ip": "ip address addr host server adresse login from client",
    "card": "card visa mastercard amex credit carte karte tarjeta payment paid",
    "phone": "phone tel telephone call mobile cell fax telefon téléphone teléfono appelez",
    "secret": "token secret password passwd pwd key apikey credential credentials bearer auth authorization passwort contraseña",
}
PREFIXES = ["AKIA", "ASIA", "AIza", "ghp_", "gho_", "github_pat_", "glpat-", "xoxb-", "xoxp-", "sk-", "sk_live_", "pk_live_", "eyJ"]
DIGESTS = "commit sha sha1 sha256 md5 checksum digest hash uuid guid etag build revision"
DOUBTS = "version ver isbn issn order invoice ref section figure doi id serial sku part"
LABELERS = 5
#: Least probability with which a candidate is added.
ADD_AT = 0.9


def _hits(text: Column, pattern: str, worth: Column) -> Column:
    """(matches, pieces between them) where ``worth`` holds, else none."""
    none = F.array().cast("array<string>")
    return F.struct(
        F.when(worth, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none).alias("hits"),
        F.when(worth, F.split(text, pattern, -1)).otherwise(none).alias("gaps"),
    )


def _placed(found: Column) -> Column:
    """Structs (s, e, hit, before, after) of the matches; positions are code
    points, the end is exclusive, ``before`` the 40 characters ahead."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int,hit:string,before:string,after:string>>").alias("out"))

    def step(acc: Column, i: Column) -> Column:
        hit, gap = found["hits"][i], found["gaps"][i]
        s = acc["at"] + F.length(gap)
        e = s + F.length(hit)
        one = F.struct(s.alias("s"), e.alias("e"), hit.alias("hit"), F.right(gap, F.lit(40)).alias("before"), F.left(found["gaps"][i + 1], F.lit(1)).alias("after"))
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    n = F.size(found["hits"])
    steps = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, start, step)["out"]


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """True if the digits (at most 19) pass the Luhn sum."""
    back = F.reverse(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return acc + F.when(i % 2 == 0, twice).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)
    return total % 10 == 0


def _byte_part(part: Column) -> Column:
    """A number of at most 255, however many zeros lead it."""
    p = F.regexp_replace(part, "^0+(?=[0-9])", "")
    return (F.length(p) < 3) | ((F.length(p) == 3) & (p <= F.lit("255")))


def _plausible(kind: str, hit: Column) -> Column:
    """The checks that base spans of a kind must pass."""
    n = F.length(_digits(hit))
    if kind == "ip":
        return F.forall(F.split(hit, r"\."), _byte_part)
    if kind == "card":
        return F.when(n.between(14, 19), _luhn(_digits(hit))).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(10, 15)
    if kind == "secret":
        # Digits all through, and no long word in plain letters.
        return (n * 10 >= F.length(hit)) & ~hit.rlike("[A-Z]?[a-z]{9}")
    return F.lit(True)


def _any_word(text: Column, words: str) -> Column:
    return text.rlike(r"(?i)(?<!\p{L})(?:" + "|".join(words.split()) + r")(?!\p{L})")


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, F.lit("p")).when(no, F.lit("n")).otherwise(F.lit("0"))


def _gazetteer(kind: str, hit: Column) -> Column:
    if kind == "email":
        known = F.lower(F.regexp_extract(hit, r"([A-Za-z0-9-]+)$", 1)).isin(ENDINGS)
        return _vote(known, ~known)
    if kind == "card":
        known = _digits(hit).rlike("^(?:" + "|".join(ISSUERS) + ")")
        return _vote(known, ~known)
    if kind == "phone":
        known = hit.rlike("^(?:" + "|".join(x.replace("+", r"\+") for x in CALLING) + ")(?![0-9]{3}[0-9])")
        return _vote(known, F.lit(False))
    if kind == "secret":
        return _vote(hit.rlike("^(?:" + "|".join(PREFIXES) + ")"), F.lit(False))
    special = hit.rlike(r"^0*(?:0|22[4-9]|2[3-9][0-9])\.")
    return _vote(~special, special)


def _candidate(kind: str, base: Column, x: Column) -> Column:
    """Votes and features of one placed match."""
    hit, n = x["hit"], F.length(_digits(x["hit"]))
    sound = _plausible(kind, hit)
    joined = x["before"].rlike(r"[\p{L}0-9_]$") | x["after"].rlike(r"^[\p{L}0-9_]")
    doubts = DOUBTS
    if kind == "secret":
        # Parts of addresses and file names stand beside dots and at signs.
        joined = joined | x["before"].rlike(r"[.@]$") | x["after"].rlike(r"^[.@]")
        # Bare hexadecimal may be any digest, unless a word says otherwise.
        sound = sound & (_any_word(x["before"], HINTS[kind]) | ~hit.rlike("^[0-9a-f]+$"))
        doubts = DIGESTS
    votes = F.concat(
        _vote(base, F.lit(False)),
        _vote(sound, ~sound),
        _gazetteer(kind, hit),
        _vote(_any_word(x["before"], HINTS[kind]), _any_word(x["before"], doubts)),
        _vote(~joined, joined),
    )
    side = lambda c: F.when(c == "", "none").when(c.rlike(r"\s"), "space").when(c.rlike(r"\p{L}"), "letter").when(c.rlike("[0-9]"), "digit").otherwise("mark")
    features = F.concat_ws(
        "|",
        F.concat(F.lit("digits"), F.least(n, F.lit(20)).cast("string")),
        F.concat(F.lit("left "), side(F.right(x["before"], F.lit(1)))),
        F.concat(F.lit("right "), side(x["after"])),
        F.concat(F.lit("size"), F.least((F.length(hit) / 4).cast("int"), F.lit(12)).cast("string")),
        F.when(hit.contains(" "), "spaced").when(hit.contains("-"), "dashed").otherwise("plain"),
    )
    return F.struct(
        x["s"].alias("s"), F.lit(KINDS.index(kind)).alias("kind"), x["e"].alias("e"), base.alias("base"), votes.alias("votes"), features.alias("features")
    )


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` (with ``text``) and ``found``: every candidate span with its
    votes and features.  Texts in which a kind cannot occur skip its scan."""
    t = F.col("text")
    worth = {
        "email": t.contains("@"),
        "ip": t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
        "card": t.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"),
        "phone": t.rlike(r"\+[0-9]|[0-9]\)?[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}"),
        "hidden": t.rlike(r"[\[(]at[\])]"),
        "secret": t.rlike(SECRET),
    }
    pattern = {"email": EMAIL, "ip": IP, "card": CARD, "phone": f"{PHONE}|{PLAIN_PHONE}", "hidden": HIDDEN_EMAIL, "secret": SECRET}
    out = docs.withColumns({f"__{k}_raw": _hits(t, pattern[k], worth[k]) for k in pattern})
    out = out.withColumns({f"__{k}": _placed(F.col(f"__{k}_raw")) for k in pattern})

    def judged(kind: str):
        def one(x: Column) -> Column:
            base = _plausible(kind, x["hit"]) if kind in BASE_KINDS else F.lit(False)
            return _candidate(kind, base & x["hit"].startswith("+") if kind == "phone" else base, x)

        return one

    own = [F.transform(F.col(f"__{kind}"), judged(kind)) for kind in KINDS]
    clear = F.filter(F.col("__hidden"), lambda x: ~F.exists(F.col("__email"), lambda y: (x["s"] < y["e"]) & (y["s"] < x["e"])))
    own.append(F.transform(clear, lambda x: _candidate("email", F.lit(False), x)))
    all_ = F.array_sort(F.concat(*own))
    # Numbers too short for any card or phone are no candidates.
    digits = lambda x: F.regexp_extract(x["features"], r"^digits([0-9]+)", 1).cast("int")
    real = F.filter(all_, lambda x: x["base"] | x["kind"].isin(0, 1, 4) | ((x["kind"] == 2) & digits(x).between(13, 19)) | ((x["kind"] == 3) & digits(x).between(10, 15)))
    return out.withColumn("found", real).drop(*[f"__{k}{s}" for k in pattern for s in ("", "_raw")])


# --- reliabilities and the span classifier -----------------------------------------


@dataclass
class SpanModel:
    """Log-odds of naive Bayes: an offset for each kind, a weight for each
    (kind, feature); and the labelers' estimated reliabilities."""

    offset: dict[int, float] = field(default_factory=dict)
    weight: dict[str, float] = field(default_factory=dict)
    reliability: dict[tuple[int, int, str], float] = field(default_factory=dict)


def maximise(counts: list[tuple[int, str, int]], rounds: int = 40) -> tuple[dict[tuple[int, str], float], dict[tuple[int, int, str], float]]:
    """Posterior of each (kind, votes) and the reliability
    P(vote of labeler | class).  Base spans are true by definition, which
    fixes what the classes mean; other patterns start from their majority."""
    post = {}
    for kind, votes, _ in counts:
        lean = votes.count("p") - votes.count("n")
        post[kind, votes] = 1.0 if votes[0] == "p" else min(max(0.5 + 0.12 * lean, 0.05), 0.95)
    like: dict[tuple[int, int, str], float] = {}
    for _ in range(rounds):
        mass, seen, total = defaultdict(lambda: 1.0), defaultdict(lambda: 1.0), defaultdict(lambda: 2.0)
        for kind, votes, n in counts:
            p = post[kind, votes]
            mass[kind] += n * p
            total[kind] += n
            for c, part in ((1, n * p), (0, n * (1 - p))):
                for k, v in enumerate(votes[1:], 1):
                    seen[c, k, v] += part
        for c in (0, 1):
            for k in range(1, LABELERS):
                whole = sum(seen[c, k, v] for v in "pn0")
                like |= {(c, k, v): seen[c, k, v] / whole for v in "pn0"}
        for kind, votes, _ in counts:
            if votes[0] != "p":
                z = math.log(mass[kind] / (total[kind] - mass[kind]))
                z += sum(math.log(like[1, k, v] / like[0, k, v]) for k, v in enumerate(votes[1:], 1))
                post[kind, votes] = 1 / (1 + math.exp(-min(max(z, -30.0), 30.0)))
    return post, like


def train(found: DataFrame) -> SpanModel:
    """From ``found`` arrays: two grouped counts, combined before their
    shuffles; the first has a row per kind and vote pattern, the second one
    per kind, vote pattern and feature value."""
    spans = found.select(F.explode("found").alias("x")).select("x.kind", "x.votes", F.split("x.features", r"\|").alias("parts"))
    each = spans.select("kind", "votes", F.explode(F.concat(F.array(F.lit("")), "parts")).alias("part"))
    rows = each.groupBy("kind", "votes", "part").agg(F.count(F.lit(1)).alias("n")).collect()
    post, like = maximise(sorted((r.kind, r.votes, r.n) for r in rows if r.part == ""))
    yes, no = defaultdict(lambda: 1.0), defaultdict(lambda: 1.0)
    for r in rows:
        p = post[r.kind, r.votes]
        yes[r.kind, r.part] += r.n * p
        no[r.kind, r.part] += r.n * (1 - p)
        # The labelers other than the strict pattern are features as well.
        if r.part == "":
            for k, v in enumerate(r.votes[1:], 1):
                yes[r.kind, f"{k}{v}"] += r.n * p
                no[r.kind, f"{k}{v}"] += r.n * (1 - p)
    model = SpanModel(reliability=like)
    for kind, part in set(yes):
        prior = math.log(yes[kind, ""] / no[kind, ""])
        if part == "":
            model.offset[kind] = prior
        else:
            model.weight[f"{kind}|{part}"] = math.log(yes[kind, part] / no[kind, part]) - prior
    return model


def _probability(model: SpanModel, x: Column) -> Column:
    """The classifier's probability of a candidate."""
    lookup = lambda d: F.create_map(*[F.lit(y) for k, v in sorted(d.items()) for y in (k, float(v))])
    weights = lookup(model.weight)
    votes = F.transform(F.sequence(F.lit(2), F.lit(LABELERS)), lambda i: F.concat((i - 1).cast("string"), F.substring(x["votes"], i, F.lit(1))))
    parts = F.concat(F.split(x["features"], r"\|"), votes)
    z = F.aggregate(
        parts, F.coalesce(lookup(model.offset)[x["kind"]], F.lit(-5.0)),
        lambda acc, p: acc + F.coalesce(weights[F.concat(x["kind"].cast("string"), F.lit("|"), p)], F.lit(0.0)),
    )
    return 1 / (1 + F.exp(-z))


def accepted(found: Column, model: SpanModel) -> Column:
    """Base spans and those that the classifier adds, by start and kind."""
    if not model.weight:
        return F.filter(found, lambda x: x["base"])
    return F.filter(found, lambda x: x["base"] | (F.when(x["base"], 1.0).otherwise(_probability(model, x)) >= ADD_AT))


def span_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", names[x["kind"]], x["s"].cast("string"), x["e"].cast("string"))), ",")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans, base, text of both) of every document.

    Null text is empty and has no spans; repeated rows and rows without an id
    are documents of their own.  Candidates are written to the shared folder
    once: the model's counts and the verdicts read them, not the texts.
    """
    found = stored(candidates(keyed_text(docs, id_col, text_col)).select("doc_id", "found"), "pii-candidates")
    model = train(found)
    return found.select("doc_id", F.filter("found", lambda x: x["base"]).alias("base"), accepted(F.col("found"), model).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every accepted span replaced by its kind in angle
    brackets; overlapping spans become one, named by the first."""
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), body.alias("text"))
    model = train(candidates(src.select("text")))
    names = F.array(*[F.lit(f"<{k}>") for k in KINDS])
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        ahead = F.substring("text", acc["at"] + 1, F.greatest(x["s"] - acc["at"], F.lit(0)))
        out = F.when(x["s"] >= acc["at"], F.concat(acc["out"], ahead, names[x["kind"]])).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), out.alias("out"))

    got = candidates(src).withColumn("spans", accepted(F.col("found"), model))
    done = F.aggregate("spans", start, step)
    clean = F.when(F.size("spans") == 0, F.col("text")).otherwise(
        F.concat(done["out"], F.substring("text", done["at"] + 1, F.length("text")))
    )
    got = got.withColumn("clean", clean)
    return got.select(*[F.col("clean").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and digest, all spans, and how many secrets and other
    spans the classifier added."""
    got = find(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return got.select(
        "doc_id", *[count(k) for k in BASE_KINDS], F.sha2(span_text(F.col("base")), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda x: x["kind"] == KINDS.index("secret"))).cast("long").alias("n_secret"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_added"),
    )
