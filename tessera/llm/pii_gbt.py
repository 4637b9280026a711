"""Personal data by candidate gradient boosting, in DataFrame and SQL functions alone.

Two sets of generators run over each whole text: the strict patterns of each kind, whose valid matches are always
reported, and wide ones that propose any stretch of a number run that starts and ends with groups of digits (as a card,
a phone or an address, overlapping) or a spelled-out mail address. Boosted trees, trained on the whole corpus, where valid strict matches are the positive (mail also
spelled out) and broken ones the negative rows, score the proposals from their format and their context; a threshold per kind, calibrated on
held-out rows to a wanted precision, selects those that are reported too. The trees become one SQL expression, so
selection is a function of the row: nothing is shuffled but the counts of spans with equal features.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut_lineage, read, text_of

KINDS = ["email", "ip", "card", "phone"]
#: The wanted patterns, with possessive repeats and starts at the ends of runs, so that no text takes quadratic time.
#: They match what the plain patterns match: a run's later starts fail where its first does.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE_EMAIL = (r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:\x20?[\[(]at[\])]\x20?|\x20at\x20)[A-Za-z0-9-]++"
              r"(?:(?:\x20?[\[(]dot[\])]\x20?|\x20dot\x20)[A-Za-z0-9-]++)++")
FEATURES = ["kind", "chars", "digits", "letters", "separators", "groups", "luhn", "octets", "domain", "cut", "before", "after",
            "cue_own", "cue_other"]
CUES = {
    "email": r"(?i)mail|contact|write|reach",
    "ip": r"(?i)\bip\b|host|server|addr|login",
    "card": r"(?i)card|visa|credit|account|paid",
    "phone": r"(?i)phone|tel|call|fax|mobile|whatsapp",
}
OTHER_CUE = r"(?i)token|key|secret|hash|isbn|order|invoice|serial|\bid\b"
#: last labels of mail addresses: two letters (countries), the usual generic ones, and those reserved for examples
DOMAIN = (r"(?i)(?<![A-Za-z0-9-])([a-z]{2}|com|org|net|edu|gov|mil|int|info|biz|name|pro|mobi|museum|coop|aero|jobs|travel|app|dev|"
          r"xyz|online|site|tech|store|shop|blog|cloud|club|email|news|live|world|agency|example|test|invalid|local|localhost)$")
CONTEXT = 24


RUN = 128


def _located(df: DataFrame, wanted: dict[str, tuple[str, Column]]) -> DataFrame:
    """For each ``out: (pattern, when)`` add ``out``: array of (s, start, end, left, right) of the pattern's matches in
    ``text``, in code points; none where ``when`` is false.

    A match ends at the running sum of the lengths of matches and of gaps between them. The sums are taken in runs, so
    that a long array doesn't take quadratic time. Each part is a column of its own, so it is computed once a row.
    """
    none, zero = F.array().cast("array<string>"), F.lit(0).cast("long")
    add = lambda a, b: a + b

    def layer(df: DataFrame, name: str, of) -> DataFrame:
        return df.withColumns({f"{name}_{out}": of(out) for out in wanted})

    def col(name: str, out: str) -> Column:
        return F.col(f"{name}_{out}")

    def steps(out: str) -> Column:
        gaps = col("gaps", out)
        return F.transform(col("hits", out), lambda s, i: (F.length(gaps[i]) + F.length(s)).cast("long"))

    def runs(out: str) -> Column:
        all_steps = col("steps", out)
        return F.transform(F.sequence(F.lit(0), F.floor(F.size(all_steps) / RUN).cast("int")), lambda c: F.slice(all_steps, c * RUN + 1, F.lit(RUN)))

    def bases(out: str) -> Column:
        sums = col("sums", out)
        return F.transform(sums, lambda _, c: F.aggregate(F.slice(sums, F.lit(1), c), zero, add))

    def ends(out: str) -> Column:
        base = col("bases", out)
        return F.flatten(F.transform(col("runs", out), lambda r, c: F.transform(r, lambda _, i: base[c] + F.aggregate(F.slice(r, F.lit(1), i + 1), zero, add))))

    def found(out: str) -> Column:
        gaps, at = col("gaps", out), col("ends", out)
        return F.transform(col("hits", out), lambda s, i: F.struct(
            s.alias("s"), (at[i] - F.length(s)).cast("long").alias("start"), at[i].cast("long").alias("end"),
            F.substring(gaps[i], -CONTEXT, CONTEXT).alias("left"), F.substring(gaps[i + 1], 1, CONTEXT).alias("right")))

    kept = df.columns
    df = layer(df, "hits", lambda o: F.when(wanted[o][1], F.regexp_extract_all("text", F.lit(wanted[o][0]), F.lit(0))).otherwise(none))
    df = layer(df, "gaps", lambda o: F.when(F.size(col("hits", o)) > 0, F.split("text", wanted[o][0], -1)).otherwise(none))
    df = layer(df, "steps", steps)
    df = layer(df, "runs", runs)
    df = layer(df, "sums", lambda o: F.transform(col("runs", o), lambda r: F.aggregate(r, zero, add)))
    df = layer(df, "bases", bases)
    df = layer(df, "ends", ends)
    return df.select(*kept, *[found(o).alias(o) for o in wanted])


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _octets(s: Column, separator: str = r"\.") -> Column:
    return F.forall(F.split(s, separator), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(999)) <= 255))


def _valid(kind: str, s: Column) -> Column:
    n = F.length(_digits(s))
    return {"email": F.lit(True), "ip": _octets(s), "card": n.between(16, 19) & F.call_function("luhn_check", _digits(s)), "phone": n.between(8, 15)}[kind]


def _vector(kind: int, x: Column) -> Column:
    """A span with its features, from (s, start, end, left, right)."""
    s, name = x["s"], KINDS[kind]
    number = {
        "kind": F.lit(kind), "chars": F.length(s), "digits": F.length(_digits(s)), "letters": F.length(F.regexp_replace(s, "[^A-Za-z]", "")),
        "separators": F.length(F.regexp_replace(s, "[A-Za-z0-9]", "")), "groups": F.size(F.split(s, "[^A-Za-z0-9]+")),
        "luhn": F.call_function("luhn_check", _digits(s)).cast("int"), "octets": _octets(s, "[^0-9]+").cast("int"),
        "domain": s.rlike(DOMAIN).cast("int") if name == "email" else F.lit(0),
        "cut": (x["left"].rlike(r"[0-9)][.-]$") | x["right"].rlike(r"^[.-][0-9(]")).cast("int"),  # tied to a number beside it
        "before": x["left"].rlike(r"[A-Za-z0-9]$").cast("int"), "after": x["right"].rlike(r"^[A-Za-z0-9]").cast("int"),
        "cue_own": x["left"].rlike(CUES[name]).cast("int"), "cue_other": x["left"].rlike(OTHER_CUE).cast("int"),
    }
    return F.struct(F.lit(kind).alias("k"), x["start"].alias("start"), x["end"].alias("end"),
                    *[F.coalesce(number[f], F.lit(0)).cast("double").alias(f) for f in FEATURES])


def _in_valid(kind: str) -> Column:
    """For each group of digits in ``text`` whether it is in a valid strict span of the kind."""
    hits = F.regexp_extract_all("text", F.lit(f"{STRICT[kind]}|[0-9]++"), F.lit(0))
    whole = {"ip": r"\.", "card": "", "phone": r"^\+"}[kind]  # else it is a group by itself
    return F.flatten(F.transform(hits, lambda s: F.array_repeat(s.rlike(whole) & _valid(kind, s), F.size(F.regexp_extract_all(s, F.lit("[0-9]+"), F.lit(0))))))


MOST_DIGITS = 19  # and so the most groups


def _number_spans(groups: Column) -> Column:
    """All stretches of 7 to MOST_DIGITS digits from the start of a group to the end of one, with gaps of at most two
    separators, and none beside a letter: (s, start, end, left, right), whether a group is in a valid ip, card or
    phone, and whether one is in none (free)."""
    text, no = F.lit(""), F.lit(False)
    part = "struct<s:string,start:bigint,end:bigint,left:string,right:string,ip:boolean,card:boolean,phone:boolean,free:boolean>"

    def from_group(g: Column, i: Column) -> Column:
        back = lambda k, f: F.coalesce(F.get(groups, i - k)[f], text)
        opened = g["left"].rlike(r"(^|[^A-Za-z0-9+])\($")
        before = F.concat(back(2, "left"), back(2, "s"), back(1, "left"), back(1, "s"), F.when(opened, F.left(g["left"], F.length(g["left"]) - 1)).otherwise(g["left"]))
        left = F.substring(before, -CONTEXT, CONTEXT)
        start = g["start"] - opened.cast("long")
        zero = F.struct(F.when(opened, F.lit("(")).otherwise(text).alias("s"), F.lit(0).alias("n"), F.lit(0).alias("groups"), F.lit(True).alias("on"), no.alias("ip"), no.alias("card"),
                        no.alias("phone"), no.alias("free"), F.array().cast(f"array<{part}>").alias("out"))

        def longer(a: Column, x: Column) -> Column:
            first = a["groups"] == 0
            n = a["n"] + F.length(x["s"])
            on = a["on"] & (first | x["tied"]) & (n <= MOST_DIGITS)
            s = F.concat(a["s"], F.when(first, text).otherwise(x["left"]), x["s"])
            flags = {k: a[k] | x[k] for k in ("ip", "card", "phone", "free")}
            here = F.struct(s.alias("s"), start.alias("start"), x["end"].alias("end"), left.alias("left"), x["after"].alias("right"), *[v.alias(k) for k, v in flags.items()]).cast(part)
            grown = F.struct(s.alias("s"), n.alias("n"), (a["groups"] + 1).alias("groups"), on.alias("on"), *[v.alias(k) for k, v in flags.items()],
                             F.when((n >= 7) & x["ends"], F.concat(a["out"], F.array(here))).otherwise(a["out"]).alias("out"))
            done = F.struct(*[(no if k == "on" else a[k]).alias(k) for k in ("s", "n", "groups", "on", *flags, "out")])
            return F.when(on, grown).otherwise(done)

        spans = F.aggregate(F.slice(groups, i + 1, F.lit(MOST_DIGITS)), zero, longer, lambda a: a["out"])
        return F.when(g["left"].rlike("[A-Za-z+]$"), F.array().cast(f"array<{part}>")).otherwise(spans)

    return F.flatten(F.transform(groups, from_group))


def _groups() -> Column:
    """The located groups of digits with their flags: tied to the one before, at no letter's left, in valid spans."""
    g = F.col("w_group")

    def flagged(x: Column, i: Column) -> Column:
        held = {k: F.coalesce(F.get(F.col(f"in_{k}"), i), F.lit(False)) for k in ("ip", "card", "phone")}
        after = F.substring(F.concat(x["right"], F.coalesce(F.get(g, i + 1)["s"], F.lit(""))), 1, CONTEXT)
        return F.struct(x["s"].alias("s"), x["start"].alias("start"), x["end"].alias("end"), x["left"].alias("left"), after.alias("after"),
                        ((i > 0) & x["left"].rlike(r"^[\x20().-]{1,2}$")).alias("tied"), (~x["right"].rlike("^[A-Za-z]")).alias("ends"),
                        *[v.alias(k) for k, v in held.items()], (~(held["ip"] | held["card"] | held["phone"])).alias("free"))

    return F.transform(g, flagged)


def _spelled(s: Column) -> list[Column]:
    """Ways to spell a mail address out."""
    return [F.regexp_replace(F.regexp_replace(s, "@", f" {a}at{b} "), r"\.", f" {a}dot{b} ") for a, b in (("", ""), ("[", "]"))]


def _broken_forms(kind: str, s: Column) -> list[Column]:
    """A valid span broken: mail (plain and spelled out) whose last label is no domain, an octet out of range, a wrong
    check digit, too few and too many digits."""
    if kind == "email":
        none = F.regexp_replace(s, ".$", "0")
        return [none, *_spelled(none)]
    if kind == "ip":
        return [F.regexp_replace(s, "^[0-9]+", "999")]
    if kind == "card":
        return [F.concat(F.regexp_replace(s, "[0-9]$", ""), ((F.right(s, F.lit(1)).cast("int") + 1) % 10).cast("string"))]
    return [F.substring(s, 1, 6), F.concat(s, F.lit("00000000"))]


def generate(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Per row of ``docs``: the columns ``keep`` as a struct ``doc``, ``base`` (valid strict spans), ``broken`` (strict matches that fail
    their check, spelled-out mail whose last label is no domain, and valid spans broken on purpose or tied to a number), ``spelled`` (valid
    mail, spelled out) and ``proposed`` (wide spans: stretches of number runs, with no part
    of a valid strict span of their kind, and not all of it in valid ones of others); each span with features. Every kind
    that has valid spans so has negative rows. Null text is read as empty."""
    keep = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*[F.col(c) for c in keep]).alias("doc"), text_of(text).alias("text"))
    digit = F.col("text").rlike("[0-9]")
    rows = rows.withColumn("_digit", digit)
    when = {"email": F.contains("text", F.lit("@")), "ip": F.col("_digit"), "card": F.col("_digit"), "phone": F.contains("text", F.lit("+"))}
    wanted = {f"m_{k}": (STRICT[k], when[k]) for k in KINDS}
    wanted |= {"w_group": ("[0-9]++", F.col("_digit")), "w_email": (WIDE_EMAIL, F.contains(F.lower("text"), F.lit("dot")))}
    rows = _located(rows, wanted)
    in_valid = {f"in_{k}": F.when(F.size("w_group") > 0, _in_valid(k)).otherwise(F.array().cast("array<boolean>")) for k in ("ip", "card", "phone")}
    rows = rows.withColumns(in_valid).withColumn("groups", _groups()).withColumn("w_number", _number_spans(F.col("groups")))
    # short digit runs are no broken cards
    def valid(kind: str) -> Column:
        return F.filter(f"m_{kind}", lambda x: _valid(kind, x["s"]))

    def broken(kind: str) -> Column:
        return F.filter(f"m_{kind}", lambda x: ~_valid(kind, x["s"]) & (F.length(_digits(x["s"])) >= (13 if kind == "card" else 0)))

    def forms(kind: str, of) -> Column:
        """Spans of the kind as valid ones would be in another form, in their place."""
        def change(x: Column) -> Column:
            made = [(s, x["left"], x["right"]) for s in of(x["s"])]
            if kind != "email":
                made += [(x["s"], F.concat(x["left"], F.lit("0-")), x["right"]), (x["s"], x["left"], F.concat(F.lit("-0"), x["right"]))]
            return F.array(*[F.struct(s.alias("s"), x["start"].alias("start"), x["end"].alias("end"), a.alias("left"), b.alias("right")) for s, a, b in made])

        return F.flatten(F.transform(valid(kind), change))

    spans = lambda col, k: F.transform(col, lambda x: _vector(k, x))
    rows = rows.select("doc", *[valid(k).alias(f"m_{k}") for k in KINDS],
                       *[F.concat(broken(k), forms(k, lambda s, k=k: _broken_forms(k, s))).alias(f"b_{k}") for k in KINDS],
                       forms("email", _spelled).alias("spelled"),
                       F.filter("w_number", lambda x: x["free"]).alias("w_number"), "w_email")
    n = lambda x: F.length(_digits(x["s"]))
    return rows.select(
        "doc", F.concat(*[spans(f"m_{k}", i) for i, k in enumerate(KINDS)]).alias("base"),
        F.concat(*[spans(f"b_{k}", i) for i, k in enumerate(KINDS)], spans(F.filter("w_email", lambda x: ~x["s"].rlike(DOMAIN)), 0)).alias("broken"),
        spans("spelled", 0).alias("spelled"),
        F.concat(spans("w_email", 0),
                 spans(F.filter("w_number", lambda x: ~x["ip"] & x["s"].rlike(r"^[0-9]{1,3}([\x20.-]{1,2}[0-9]{1,3}){3}$")), 1),
                 spans(F.filter("w_number", lambda x: ~x["card"] & n(x).between(13, 19)), 2),
                 spans(F.filter("w_number", lambda x: ~x["phone"] & n(x).between(7, 15)), 3)).alias("proposed"))


def _tree(node, value) -> Column:
    if node.getClass().getSimpleName() == "LeafNode":
        return F.lit(float(node.prediction()))
    split = node.split()
    return F.when(value(FEATURES[split.featureIndex()]) <= F.lit(float(split.threshold())), _tree(node.leftChild(), value)).otherwise(_tree(node.rightChild(), value))


def fit(spans: DataFrame, rounds: int = 10, depth: int = 3, precision: float = 0.995) -> tuple[list, dict[int, float]]:
    """Boosted trees and a threshold per kind from the output of ``generate`` (a written table).

    Every labelled span counts. Spans of one label with equal features become one row that weighs as many as they are,
    so the trees are grown on a few rows whatever the input; each label weighs the same in all. By a hash of their place
    a third of the spans is held out;
    a kind's threshold lies halfway between the lowest score from which on at least ``precision`` of its held-out spans
    are positive and the next score below.
    Kinds without held-out rows of both labels get none, and report their strict spans alone: those that have hardly
    any valid strict span.
    """
    labelled = spans.select("doc", F.explode(F.concat(
        F.transform(F.concat("base", "spelled"), lambda x: F.struct(F.lit(1.0).alias("label"), x.alias("x"))),
        F.transform("broken", lambda x: F.struct(F.lit(0.0).alias("label"), x.alias("x"))))).alias("y")).select(
        "y.label", "y.x.k", *[f"y.x.{f}" for f in FEATURES], (F.pmod(F.xxhash64("doc", "y.x.k", "y.x.start"), F.lit(3)) == 0).alias("held"))
    rows = cut_lineage(labelled.groupBy("label", "held", "k", *FEATURES).agg(F.count(F.lit(1)).alias("n")))
    sizes = {r["label"]: r["n"] for r in rows.where("not held").groupBy("label").agg(F.sum("n").alias("n")).collect()}
    if set(sizes) != {0.0, 1.0}:
        return [], {}
    weight = F.when(F.col("label") == 1, F.col("n") / sizes[1.0]).otherwise(F.col("n") / sizes[0.0]) * min(sizes.values())
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="v").transform(rows.where("not held").withColumn("weight", weight))
    model = GBTClassifier(featuresCol="v", labelCol="label", weightCol="weight", maxIter=rounds, maxDepth=depth, seed=7, subsamplingRate=1.0, stepSize=0.3).fit(
        vectors.select("v", "label", "weight"))
    trees = [(t._call_java("rootNode"), float(w)) for t, w in zip(model.trees, model.treeWeights, strict=True)]
    bins = rows.where("held").groupBy("k", "label", F.round(score(trees, F.col), 2).alias("score")).agg(F.sum("n").alias("count")).collect()
    cuts = {}
    for kind in range(len(KINDS)):
        own = sorted(((r["score"], r["label"], r["count"]) for r in bins if r["k"] == kind), reverse=True)
        if {x[1] for x in own} != {0.0, 1.0}:
            continue
        good = bad = 0
        levels = sorted({x[0] for x in own}, reverse=True)
        for s, lower in zip(levels, [*levels[1:], levels[-1] - 1], strict=True):
            good += sum(c for x, label, c in own if x == s and label == 1)
            bad += sum(c for x, label, c in own if x == s and label == 0)
            if good >= precision * (good + bad):
                cuts[kind] = (s + lower) / 2
    return trees, cuts


def score(trees: list, value) -> Column:
    return sum((_tree(root, value) * F.lit(w) for root, w in trees), F.lit(0.0))


def select(spans: DataFrame, model: tuple[list, dict[int, float]]) -> DataFrame:
    """``doc``, ``base`` and ``spans``: base and the proposals that reach their kind's threshold, by kind, then start."""
    trees, cuts = model
    taken = F.array().cast("array<struct<k:int,start:bigint,end:bigint>>")
    plain = lambda col: F.transform(col, lambda x: F.struct(x["k"].alias("k"), x["start"].alias("start"), x["end"].alias("end")))
    if cuts:
        cut = F.lit(None).cast("double")
        chosen = F.filter("proposed", lambda x: F.coalesce(F.round(score(trees, lambda f: x[f]), 2) >= _of(cuts, x["k"], cut), F.lit(False)))
        taken = plain(chosen)
    return spans.select("doc", F.array_sort(plain("base")).alias("base"), F.array_sort(F.array_distinct(F.concat(plain("base"), taken))).alias("spans"))


def _of(cuts: dict[int, float], kind: Column, other: Column) -> Column:
    for k, v in cuts.items():
        other = F.when(kind == k, F.lit(v)).otherwise(other)
    return other


def as_string(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", names[x["k"]], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, mark: str = "[PII]") -> Column:
    """``text`` with each stretch that spans cover (overlaps merged) replaced by ``mark``."""
    starts = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))))
    first = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at"))
    end = F.aggregate(starts, first, lambda a, x: F.struct(
        F.when(x["start"] >= a["at"], F.concat(a["done"], F.substring(text, (a["at"] + 1).cast("int"), (x["start"] - a["at"]).cast("int")), F.lit(mark))).otherwise(a["done"]).alias("done"),
        F.greatest(a["at"], x["end"]).alias("at")))
    return F.concat(end["done"], F.substring(text, (end["at"] + 1).cast("int"), F.length(text)))


def find_pii(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Spans of personal data for each row of ``docs``; see ``generate``, ``fit`` and ``select``.

    Null text: no spans. Empty input: empty result. Equal rows get equal spans. Columns beyond ``keep`` and text are
    not read.
    """
    spans = cut_lineage(generate(docs, keep=keep))
    return select(spans, fit(spans))


def op1_gbt_pii(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = find_pii(docs, ["doc_id"])
    count = lambda i: F.size(F.filter("base", lambda x: x["k"] == i)).cast("long")
    return out.select("doc.doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
                      F.sha2(as_string(F.col("base")), 256).alias("base_sha256"), as_string(F.col("spans")).alias("spans"))
