"""Personal data: generators propose spans, boosted trees score them, calibrated thresholds select them.

Base spans follow fixed rules and always stay. Generators propose further spans, which may overlap each other and the base: numbers
and addresses in the usual formats wherever they stand, also where a neighbouring number makes the base rule fail, and mail
addresses with the sign or the dots spelt out. Each candidate has a few small features of format (number of digits of a
card, separators, first sign) and context (a cue word before it, its own or one of order numbers and the like, what it touches).
Whether its checksum or ranges hold is no feature, nor is what fixes that, such as the number of digits of a phone.

Boosted trees of depth two learn from the corpus itself, over all documents, in which formats and contexts candidates are of their
kind: those equal to a base span count for it, those whose checksum or ranges fail against it, unless the other reading from
the same start holds; the rest has no label. As features take few values, the corpus is reduced to counts
per combination of values, at most a few thousand rows, and the trees are fitted to these counts. Candidates
of every fourth document (by checksum of its id) are left out of the fit. On them the scores of a kind are taken in bins from the highest on, and its
limit is the lowest score down to which every bin reaches the wanted precision: numbers that are not of the kind pass its check by chance (``CHANCE``), so the
failing ones tell how many of the passing ones are such. Candidates that pass their check, reach the limit and lie on no base span
are added, the best first where they overlap. A kind with fewer than ``LEAST_HELD`` labelled candidates in the documents left out is judged
on all its labelled candidates, and if these are too few as well, it gets none added.

All work on texts is done by built-in functions. A span's place is the sum of the lengths of what lies before it: texts
are cut at the matches, which gives the gaps. Quantifiers are possessive and matches begin at the start of a run, so long runs take linear time.

Defined results: NULL and empty texts have no spans; their span lists are empty strings. Repeated rows each get a row. Starts and ends count code
points, ends exclusive. Extra columns are ignored. Without candidates to learn from, nothing is added.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import table
from millrace.session import materialise

KINDS = ("email", "ip", "card", "phone")
LOCAL = "[A-Za-z0-9._%+-]"
RUN_START = rf"(?:\G|(?<!{LOCAL}))"

BASE = {
    "email": rf"{RUN_START}{LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
DOT = r"(?:\.| ?[\[(] ?dot ?[\])] ?)"
GENERATORS = (
    ("email", rf"{RUN_START}{LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+"),
    ("email", rf"{RUN_START}{LOCAL}++ ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]++(?:{DOT}[A-Za-z0-9-]++)*+"),
    ("ip", r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])"),
    ("ip", r"(?<![0-9.])[0-9]{1,3}(?:\[\.\][0-9]{1,3}){3}(?![0-9])"),
    ("card", r"(?<![0-9])[0-9]{14,19}(?![0-9])"),
    ("card", r"(?<![0-9])[0-9]{4}(?:[ -][0-9]{4}){3}(?![0-9])"),
    ("phone", r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,3}?(?![0-9])"),
    ("phone", r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])"),
)
CUES = {
    "email": "mail|contact|write|schreib|correo|courriel",
    "ip": r"\bip\b|server|host|addr|adres",
    "card": "card|visa|credit|karte|tarjeta|carte",
    "phone": "phone|tel|call|fax|mobil|cell|ruf|llam",
}
#: Words before numbers of other kinds: orders, invoices, parcels, versions and the like.
OTHER_CUE = "order|invoice|ticket|parcel|tracking|serial|version|isbn|bestell|rechnung|sendung|pedido|factura|commande|facture"
#: Share of what is not of a kind that passes its check: one last digit of ten fits a checksum, ranges are taken to let half pass.
CHANCE = {"email": 0.5, "ip": 0.5, "card": 0.1, "phone": 0.5}
CONTEXT = 24
CHUNK = 256
PRECISION, LEAST_HELD = 0.98, 20
TREES, RATE = 30, 0.3
#: Numbers of values of each feature, which bound the rows that the fit sees.
FEATURES = {"kind": 4, "digits": 4, "sep": 5, "lead": 7, "cue": 3, "touch": 3}


def pieces(text: Column, pattern: str) -> Column:
    """Array of (start, end, hit, before): the matches with their places and what stands before them.

    Places are summed within chunks of matches and then over the chunks, so a text with very many takes little more than linear
    time. A one-element array around a value makes it a variable, which is evaluated once.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(hits, F.split(text, pattern, -1), lambda h, g: F.struct(h.alias("h"), g.alias("g")))
    kind = "array<struct<start:int,end:int,hit:string,before:string>>"
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("found"))

    def step(done, pair):
        begin = done["at"] + F.length(pair["g"])
        end = begin + F.coalesce(F.length(pair["h"]), F.lit(0))
        one = F.struct(begin.alias("start"), end.alias("end"), pair["h"].alias("hit"), F.substring(pair["g"], -CONTEXT, CONTEXT).alias("before"))
        more = F.when(pair["h"].isNull(), done["found"]).otherwise(F.concat(done["found"], F.array(one)))
        return F.struct(end.alias("at"), more.alias("found"))

    def moved(by):
        return lambda x: F.struct((x["start"] + by).alias("start"), (x["end"] + by).alias("end"), x["hit"].alias("hit"), x["before"].alias("before"))

    def joined(chunks):
        sums = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        begins = F.aggregate(
            chunks,
            sums,
            lambda done, c: F.struct((done["at"] + c["at"]).alias("at"), F.concat(done["out"], F.array(done["at"])).alias("out")),
            lambda done: done["out"],
        )
        return F.flatten(F.zip_with(chunks, begins, lambda c, by: F.transform(c["found"], moved(by))))

    def placed(all_pairs):
        numbers = F.sequence(F.lit(0), F.floor((F.size(all_pairs) - 1) / CHUNK).cast("int"))
        chunks = F.transform(numbers, lambda n: F.aggregate(F.slice(all_pairs, n * CHUNK + 1, CHUNK), nothing, step))
        return F.get(F.transform(F.array(chunks), joined), F.lit(0))

    return F.get(F.transform(F.array(pairs), placed), F.lit(0))


def digits_of(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(hit: Column) -> Column:
    """Whether the digits pass the checksum of card numbers."""
    digits = digits_of(hit)
    # from the last digit on, every second one is doubled, and nine taken off above nine
    signs = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    weighed = F.transform(
        signs,
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)),
    )
    return F.aggregate(weighed, F.lit(0), lambda a, b: a + b) % 10 == 0


def parts_hold(hit: Column) -> Column:
    """Whether all parts of an address are at most 255, leading zeros aside."""
    return F.forall(
        F.filter(F.split(hit, "[^0-9]+"), lambda p: p != ""),
        lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (F.substring(F.regexp_replace(p, "^0+", ""), 1, 3).try_cast("int").isNull() | (F.substring(F.regexp_replace(p, "^0+", ""), 1, 3).try_cast("int") <= 255)),
    )


def holds(kind: str, hit: Column) -> Column:
    size = F.length(digits_of(hit))
    if kind == "email":
        return hit.rlike(rf"(?:@|at ?[\])]).*{DOT}")
    if kind == "ip":
        return parts_hold(hit)
    if kind == "card":
        return F.when(size.between(14, 19), luhn(hit)).otherwise(False)
    return size.between(10, 15)


#: The fields of a candidate in the order of the fits; ``tag`` is 0 for a base span, which has neither check nor features.
SPAN = "struct<start:int,kind:int,end:int>"
TAGGED = "struct<start:int,kind:int,end:int,tag:int,holds:int," + ",".join(f"{f}:int" for f in FEATURES if f != "kind") + ">"


def found_in(text: Column) -> tuple[Column, Column]:
    """Base spans (start, kind, end) and candidates (the same, check, features, and ``tag`` 1) of a text."""
    has_at, has_digit = text.rlike("@|at ?[\\])]"), text.rlike("[0-9]")
    some = lambda kind, spans, of: F.coalesce(F.when(has_at if kind == "email" else has_digit, spans.cast(f"array<{of}>")), F.array().cast(f"array<{of}>"))
    base = F.flatten(F.array(*[some(k, F.transform(F.filter(pieces(text, p), passes(k)), spanned(k)), SPAN) for k, p in BASE.items()]))
    candidates = F.flatten(F.array(*[some(k, F.transform(pieces(text, p), featured(k)), TAGGED) for k, p in GENERATORS]))
    return base, candidates


def compared(base: Column, candidates: Column) -> Column:
    """The distinct candidates in order, with ``tag`` 2 where there is an equal base span, and 3 where the check fails but holds
    for another reading from the same start: both are sorted together, so that equal ones and readings lie side by side."""
    tagged = F.transform(base, lambda b: F.struct(b["start"], b["kind"], b["end"], F.lit(0), *[F.lit(None).cast("int")] * len(FEATURES)).cast(TAGGED))
    ordered = F.array_sort(F.concat(tagged, candidates))

    def same(x, before):
        return (x["start"] == before["start"]) & (x["kind"] == before["kind"]) & (x["end"] == before["end"])

    def marked(spans):
        first = F.array(F.lit(None).cast(TAGGED))
        shifted = F.concat(first, F.slice(spans, 1, F.greatest(F.size(spans) - 1, F.lit(0))))
        paired = F.zip_with(spans, shifted, lambda x, before: F.struct(x.alias("x"), before.alias("before")))
        new = F.filter(paired, lambda p: (p["x"]["tag"] == 1) & ~F.coalesce(same(p["x"], p["before"]) & (p["before"]["tag"] == 1), F.lit(False)))
        distinct = F.transform(
            new,
            lambda p: p["x"].withField("tag", F.when(F.coalesce(same(p["x"], p["before"]), F.lit(False)), 2).otherwise(1)),
        )
        return F.get(F.transform(F.array(distinct), read), F.lit(0))

    def read(spans):
        def holding(x, other):
            return F.coalesce((other["start"] == x["start"]) & (other["kind"] == x["kind"]) & (other["holds"] == 1), F.lit(False))

        def one(x, i):
            beside = holding(x, F.get(spans, i - 1)) | holding(x, F.get(spans, i + 1))
            return F.when((x["holds"] == 0) & beside, x.withField("tag", F.lit(3))).otherwise(x)

        return F.transform(spans, one)

    return F.when(F.size(candidates) == 0, candidates).otherwise(F.get(F.transform(F.array(ordered), marked), F.lit(0)))


def passes(kind: str):
    return (lambda x: F.lit(True)) if kind == "email" else (lambda x: holds(kind, x["hit"]))


def spanned(kind: str):
    return lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), x["end"].alias("end"))


def featured(kind: str):
    return lambda x: features(kind, x)


def features(kind: str, x: Column) -> Column:
    hit, before = x["hit"], x["before"]
    size = F.length(digits_of(hit)) if kind == "card" else F.lit(0)
    # the domain of a mail address decides its check, so its separators are those before the sign
    outer = F.regexp_replace(hit, r"[@ \[(].*$", "") if kind == "email" else hit
    inner = F.regexp_replace(outer, r"[A-Za-z0-9+()\[\]@_%]", "")
    separators = F.when(inner == "", 0).when(inner.rlike("^ +$"), 1).when(inner.rlike("^-+$"), 2).when(inner.rlike(r"^\.+$"), 3).otherwise(4)
    if kind == "ip":
        separators = F.when(hit.contains("["), 4).otherwise(3)
    lead = {
        "email": F.when(hit.contains("@"), 0).otherwise(1),
        "ip": F.lit(0),
        "card": F.when(hit.startswith("3"), 2).when(hit.startswith("4"), 3).when(hit.startswith("5"), 4).when(hit.startswith("6"), 5).otherwise(6),
        "phone": F.lit(1),
    }[kind]
    own, other = before.rlike(f"(?i)(?:{CUES[kind]})"), before.rlike(f"(?i)(?:{OTHER_CUE})")
    last = F.substring(before, -1, 1)
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    return F.struct(
        x["start"].alias("start"),
        F.lit(KINDS.index(kind)).alias("kind"),
        x["end"].alias("end"),
        F.lit(1).alias("tag"),
        flag(holds(kind, hit)).alias("holds"),
        F.when(size < 15, 0).when(size == 15, 1).when(size == 16, 2).otherwise(3).alias("digits"),
        separators.alias("sep"),
        lead.alias("lead"),
        F.when(own, 1).when(other, 2).otherwise(0).alias("cue"),
        F.when(last == "", 0).when(last.rlike(r"[\p{L}\p{N}]"), 1).otherwise(2).alias("touch"),
    )


# ---- the trees --------------------------------------------------------------------------------------------------


def chance(margin: float) -> float:
    return 1 / (1 + math.exp(-max(-50.0, min(50.0, margin))))


def best_split(cells: list[dict], rows: list[int]) -> tuple | None:
    """The feature and value whose rows, against the other rows, gain most: (gain, feature, value, inside, outside)."""
    whole = (sum(cells[i]["g"] for i in rows), sum(cells[i]["h"] for i in rows))
    best = None
    for feature, values in FEATURES.items():
        for value in range(values):
            inside = [i for i in rows if cells[i][feature] == value]
            if not inside or len(inside) == len(rows):
                continue
            g, h = sum(cells[i]["g"] for i in inside), sum(cells[i]["h"] for i in inside)
            gain = g * g / (h + 1) + (whole[0] - g) ** 2 / (whole[1] - h + 1) - whole[0] ** 2 / (whole[1] + 1)
            if gain > 1e-6 and (best is None or gain > best[0]):
                kept = set(inside)
                best = (gain, feature, value, inside, [i for i in rows if i not in kept])
    return best


def boost(cells: list[dict]) -> list[list[tuple[dict, float]]]:
    """Trees as lists of (conditions, value): conditions map (feature, value) to whether it must hold.

    A cell has its features and the counts ``good`` and ``bad`` of candidates.
    """
    trees: list[list[tuple[dict, float]]] = []
    for cell in cells:
        cell["m"] = 0.0
    for _ in range(TREES):
        for cell in cells:
            p, n = chance(cell["m"]), cell["good"] + cell["bad"]
            cell["g"], cell["h"] = cell["good"] - n * p, n * p * (1 - p)
        leaves = [({}, list(range(len(cells))))]
        for _depth in range(2):
            grown = []
            for conditions, rows in leaves:
                split = best_split(cells, rows)
                if split is None:
                    grown.append((conditions, rows))
                else:
                    _, feature, value, inside, outside = split
                    grown.append(({**conditions, (feature, value): True}, inside))
                    grown.append(({**conditions, (feature, value): False}, outside))
            leaves = grown
        tree = []
        for conditions, rows in leaves:
            value = RATE * sum(cells[i]["g"] for i in rows) / (sum(cells[i]["h"] for i in rows) + 1)
            tree.append((conditions, value))
            for i in rows:
                cells[i]["m"] += value
        trees.append(tree)
    return trees


def margin_of(trees: list, candidate) -> float:
    return sum(value for tree in trees for conditions, value in tree if all((candidate[f] == v) == want for (f, v), want in conditions.items()))


def margin_column(trees: list, x: Column) -> Column:
    """The same sum as an expression over a candidate."""
    total = F.lit(0.0)
    for tree in trees:
        chosen = F.lit(0.0)
        for conditions, value in tree:
            fits = F.lit(True)
            for (feature, wanted), want in conditions.items():
                fits = fits & ((x[feature] == wanted) if want else (x[feature] != wanted))
            chosen = F.when(fits, F.lit(value)).otherwise(chosen)
        total = total + chosen
    return total


def limit_of(kind: int, cells: list[tuple[float, int, int]]) -> float | None:
    """The margin from which a kind's candidates are taken, from (margin, good, bad); None if they are too few or too bad.

    Bins are cells of like margin, as many as give ``LEAST_HELD`` candidates.
    """
    odds = CHANCE[KINDS[kind]] / (1 - CHANCE[KINDS[kind]])
    limit = None
    good = bad = 0
    cells = sorted(cells, reverse=True)
    for i, (margin, g, b) in enumerate(cells):
        good, bad = good + g, bad + b
        if good + bad < LEAST_HELD or (i + 1 < len(cells) and cells[i + 1][0] > margin - 1e-9):
            continue
        if good - odds * bad < PRECISION * good or not good:
            break
        limit = margin
        good = bad = 0
    return limit


def fit(spans: DataFrame) -> tuple[list, dict[int, float]]:
    """Trees, and per kind the margin from which its candidates are taken."""
    labelled = spans.select("held", F.explode("candidates").alias("c")).select(
        "held", *[F.col(f"c.{f}") for f in FEATURES], F.when(F.col("c.tag") == 2, 1).when((F.col("c.tag") == 1) & (F.col("c.holds") == 0), 0).alias("y")
    )
    counts = labelled.where("y IS NOT NULL").groupBy("held", *FEATURES).agg(F.sum("y").alias("good"), F.count("*").alias("n")).collect()
    sides: dict[bool, list[dict]] = {False: [], True: []}
    for row in counts:  # at most twice the product of the numbers of values
        sides[row.held].append({**{f: row[f] for f in FEATURES}, "good": row.good, "bad": row.n - row.good})
    if not sides[False]:
        return [], {}
    trees = boost(sides[False])
    limits: dict[int, float] = {}
    for kind in range(len(KINDS)):
        judged = [c for c in sides[True] if c["kind"] == kind]
        if sum(c["good"] + c["bad"] for c in judged) < LEAST_HELD:
            judged += [c for c in sides[False] if c["kind"] == kind]
        limit = limit_of(kind, [(margin_of(trees, c), c["good"], c["bad"]) for c in judged])
        if limit is not None:
            limits[kind] = limit
    return trees, limits


def select(trees: list, limits: dict[int, float]) -> Column:
    """All spans of a row: the base, and the candidates that pass their check, score enough and touch no base span nor a better one."""
    kind = "array<struct<start:int,rank:double,kind:int,end:int>>"
    base = F.transform("base", lambda b: F.struct(b["start"].alias("start"), F.lit(float("-inf")).alias("rank"), b["kind"].alias("kind"), b["end"].alias("end")))
    if not limits:
        return base.cast(kind)
    least = F.lit(float("inf"))
    passing = F.filter("candidates", lambda c: c["holds"] == 1)
    scored = F.transform(passing, lambda c: F.struct(c["start"].alias("start"), (-margin_column(trees, c)).alias("rank"), c["kind"].alias("kind"), c["end"].alias("end")))

    def enough(c):
        limit = least
        for number, margin in limits.items():
            limit = F.when(c["kind"] == number, F.lit(margin)).otherwise(limit)
        return -c["rank"] >= limit - 1e-9

    accepted = F.filter(scored, enough)
    ordered = F.array_sort(F.concat(base.cast(kind), accepted.cast(kind)))
    empty = F.array().cast(kind)
    is_base = lambda x: x["rank"] == float("-inf")

    def forward(done, x):
        return F.struct(
            F.when(is_base(x), F.greatest(done["base_end"], x["end"])).otherwise(done["base_end"]).alias("base_end"),
            F.when(is_base(x) | (x["start"] >= done["base_end"]), F.concat(done["out"], F.array(x))).otherwise(done["out"]).alias("out"),
        )

    def backward(done, x):
        return F.struct(
            F.when(is_base(x), x["start"]).otherwise(done["base_start"]).alias("base_start"),
            F.when(~is_base(x) & (x["end"] <= done["base_start"]), F.concat(done["out"], F.array(x))).otherwise(done["out"]).alias("out"),
        )

    # candidates that touch no base span on either side, then of each run of overlapping ones the best
    after = F.aggregate(ordered, F.struct(F.lit(0).alias("base_end"), empty.alias("out")), forward, lambda done: done["out"])
    free = F.aggregate(F.reverse(after), F.struct(F.lit(2**31 - 1).alias("base_start"), empty.alias("out")), backward, lambda done: done["out"])
    return F.when(F.size(accepted) == 0, base.cast(kind)).otherwise(F.concat(base.cast(kind), best_of(F.reverse(free), kind)))


def best_of(spans: Column, kind: str) -> Column:
    """Of spans by start, those that overlap none of smaller rank that is taken; ties go to the earlier start, kind and end."""
    empty = F.array().cast(kind)
    turned = kind.replace("start:int,rank:double", "rank:double,start:int")

    def best(run):
        by_rank = F.array_sort(F.transform(run, lambda x: F.struct(x["rank"], x["start"], x["kind"], x["end"])).cast(turned))
        taken = F.aggregate(
            by_rank,
            F.array().cast(turned),
            lambda done, x: F.when(F.exists(done, lambda z: (z["start"] < x["end"]) & (x["start"] < z["end"])), done).otherwise(F.concat(done, F.array(x))),
        )
        back = F.transform(taken, lambda x: F.struct(x["start"], x["rank"], x["kind"], x["end"])).cast(kind)
        return F.when(F.size(run) <= 1, run).otherwise(back)

    def step(done, x):
        new = x["start"] >= done["end"]
        return F.struct(
            F.greatest(done["end"], x["end"]).alias("end"),
            F.when(new, F.array(x)).otherwise(F.concat(done["run"], F.array(x))).alias("run"),
            F.when(new, F.concat(done["out"], best(done["run"]))).otherwise(done["out"]).alias("out"),
        )

    begin = F.struct(F.lit(0).alias("end"), empty.alias("run"), empty.alias("out"))
    return F.aggregate(spans, begin, step, lambda done: F.concat(done["out"], best(done["run"])))


def listing(spans: Column) -> Column:
    """kind:start:end of spans by start, then kind, comma-joined."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def with_spans(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, text, held (left out of the fit), base and candidates."""
    base, candidates = found_in(F.col("text"))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 0, F.lit(False))
    spans = rows.select("doc_id", "text", held.alias("held"), base.alias("base"), candidates.alias("candidates"))
    return spans.withColumn("candidates", compared(F.col("base"), F.col("candidates")))


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, base (array of start, kind, end) and all spans (array of start, rank, kind, end) of every row.

    A written table of spans and features lies between finding and selecting, so texts are read once.
    """
    spans = materialise(with_spans(docs, doc_id, text).drop("text"), "pii-spans")
    return spans.select("doc_id", "base", select(*fit(spans)).alias("spans"))


def digest(docs: DataFrame) -> DataFrame:
    found = find(docs)
    count = lambda n: F.size(F.filter("base", lambda b: b["kind"] == n)).cast("long")
    return found.select(
        "doc_id",
        *[count(n).alias(f"n_{kind}") for n, kind in enumerate(KINDS)],
        F.sha2(listing(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        listing(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and redacted: each text with its spans cut out, where spans overlap as one. Reads the texts again."""
    spans = with_spans(docs, doc_id, text)
    model = fit(materialise(spans.select("held", "candidates"), "pii-spans"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(done, x):
        gap = F.substring(F.col("text"), done["at"] + 1, F.greatest(x["start"] - done["at"], F.lit(0)))
        return F.struct(F.greatest(done["at"], x["end"]).alias("at"), F.concat(done["out"], F.array(gap)).alias("out"))

    done = F.aggregate(F.array_sort(select(*model)), start, step)
    cut = spans.select("doc_id", "text", done.alias("done"))
    rest = F.substring(F.col("text"), F.col("done.at") + 1, F.length("text"))
    return cut.select("doc_id", F.concat(F.array_join("done.out", ""), rest).alias("redacted"))


def op3_pii(spark, sf_dir):
    return digest(table(spark, sf_dir, "documents"))
