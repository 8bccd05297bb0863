"""Secrets in texts: known forms, and strings that pass tests of randomness."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.pinning import pin
from ledgerline.llm.common import documents, whole

ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
    r"([A-Za-z0-9+/_.=-]+)"
)
# The minimum lengths are part of these two: both classes are maximal runs, so no
# match that is too short hides another.
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
# Runs of the characters of all encodings, with padding.
CANDIDATE = "[A-Za-z0-9+/_-]{16,}={0,2}"

KINDS = ("assign", "access", "hex", "random")

_SPANS = "array<struct<start:int,end:int,value:string>>"


# Matches whose positions are added up in one array; arrays are copied as they grow.
_CHUNK = 256


def _bound(value: Column, use) -> Column:
    """`use` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def spans(text: Column, pattern: str) -> Column:
    """Leftmost matches that do not overlap: start, end (exclusive) and value.

    Positions are code points. The gaps between matches are what the pattern splits
    the text into; positions are their running lengths, added up in chunks and then
    within each chunk.
    """
    pieces = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, value: F.struct(F.char_length(gap).alias("gap"), value.alias("value")),
    )
    none = F.array().cast(_SPANS)

    def width(piece: Column) -> Column:
        return piece["gap"] + F.char_length(piece["value"])

    def chunks(found: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(found), F.lit(_CHUNK))
        return F.transform(starts, lambda at: F.slice(found, at, F.lit(_CHUNK)))

    def add_chunk(done: Column, chunk: Column) -> Column:
        end = F.aggregate(chunk, done["at"], lambda at, piece: at + width(piece))
        begun = F.struct(done["at"].alias("at"), chunk.alias("chunk"))
        return F.struct(end.alias("at"), F.array_append(done["chunks"], begun).alias("chunks"))

    def add_span(done: Column, piece: Column) -> Column:
        start = done["at"] + piece["gap"]
        end = done["at"] + width(piece)
        span = F.struct(start.alias("start"), end.alias("end"), piece["value"].alias("value"))
        return F.struct(end.alias("at"), F.array_append(done["spans"], span).alias("spans"))

    def walked(begun: Column) -> Column:
        begin = F.struct(begun["at"].alias("at"), none.alias("spans"))
        return F.aggregate(begun["chunk"], begin, add_span)["spans"]

    no_chunks = F.array().cast("array<struct<at:int,chunk:array<struct<gap:int,value:string>>>>")
    begin = F.struct(F.lit(0).alias("at"), no_chunks.alias("chunks"))
    found = F.filter(pieces, lambda piece: piece["value"].isNotNull())
    begun = F.aggregate(_bound(found, chunks), begin, add_chunk)["chunks"]
    return F.when(text.rlike(pattern), F.flatten(F.transform(begun, walked))).otherwise(none)


def _of_kind(found: Column, kind: str) -> Column:
    rank = KINDS.index(kind)

    def named(x: Column) -> Column:
        return F.struct(
            x["start"].alias("start"),
            F.lit(rank).alias("rank"),
            x["end"].alias("end"),
            F.lit(kind).alias("kind"),
            x["value"].alias("value"),
        )

    return F.transform(found, named)


def known_forms(text: Column) -> Column:
    """Spans of assigned secrets, access keys and hexadecimal strings."""
    long_enough = F.filter(
        spans(text, ASSIGN),
        lambda x: F.char_length(F.regexp_extract(x["value"], ASSIGN, 2)) >= 12,
    )
    return F.array_sort(
        F.concat(
            _of_kind(long_enough, "assign"),
            _of_kind(spans(text, ACCESS), "access"),
            _of_kind(spans(text, HEX), "hex"),
        )
    )


# Encodings from the narrowest alphabet: what a string consists of, what must be
# in it, its alphabet.
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = (
    ("hex", r"([0-9a-f]+|[0-9A-F]+)", r"[0-9].*[A-Fa-f]|[A-Fa-f].*[0-9]", "0123456789abcdef"),
    ("base32", r"[A-Z2-7]+", r"[2-7].*[A-Z]|[A-Z].*[2-7]", _UPPER + "234567"),
    (
        "base64",
        r"[A-Za-z0-9+/_-]+",
        r"(?=.*[a-z])(?=.*[A-Z])(?=.*[0-9]).*",
        _UPPER + _UPPER.lower() + "0123456789+/",
    ),
)
# A string must carry as many bits as a weak key, if random in its alphabet.
LEAST_BITS = 64


def _normal_tail(z: Column) -> Column:
    """Chance of a standard normal above z >= 0, after Abramowitz and Stegun 7.1.26."""
    x = z / F.lit(2.0**0.5)
    t = 1 / (1 + 0.3275911 * x)
    series = F.lit(0.0)
    for a in (1.061405429, -1.453152027, 1.421413741, -0.284496736, 0.254829592):
        series = (series + a) * t
    return F.greatest(series * F.exp(-x * x) / 2, F.lit(1e-300))


def _two_sided(z: Column) -> Column:
    return F.least(2 * _normal_tail(F.abs(z)), F.lit(1.0))


def _upper(z: Column) -> Column:
    tail = _normal_tail(F.abs(z))
    return F.when(z > 0, tail).otherwise(1 - tail)


# Letters of one case, of the other and the rest, among an encoding's characters.
CLASSES = {"hex": (6, 0, 10), "base32": (26, 0, 6), "base64": (26, 26, 12)}


def _class_counts() -> tuple[Column, Column, Column]:
    """How many characters of the body are small letters, capitals, others."""
    body = F.col("e.body")
    small = F.char_length(F.regexp_replace(body, "[^a-z]", ""))
    capital = F.char_length(F.regexp_replace(body, "[^A-Z]", ""))
    return small, capital, F.char_length(body) - small - capital


def with_randomness(tokens: DataFrame) -> DataFrame:
    """Add `encoding` and `p_random` to rows with a column `token`; keep the encoded.

    Tests whether the characters are drawn at random from the encoding's alphabet:
    chi-squared of the character counts (too uneven), in two independent parts: between
    small letters, capitals and the rest, and within these; runs above and below the
    middle of the alphabet, and correlation of neighbours (both two-sided); joined by
    Fisher's method. The moments of chi-squared are the exact ones for few characters.
    Words put together have few capitals and digits, which the first part is there for.
    Strings of no encoding, or too short for a key, are left out.
    """
    body = F.rtrim(F.col("token"), F.lit("="))
    chosen = F.lit(None)
    for name, made_of, must_have, alphabet in reversed(ENCODINGS):
        row = F.struct(
            F.lit(name).alias("name"),
            F.lit(alphabet).alias("alphabet"),
            F.lit(len(alphabet)).alias("k"),
            (F.lower(body) if name == "hex" else F.translate(body, "-_", "+/")).alias("body"),
        )
        fits = body.rlike(f"^{made_of}$") & body.rlike(must_have)
        chosen = F.when(fits, row).otherwise(chosen)
    bits = F.log2(F.col("e.k")) * F.char_length("e.body")
    rows = (
        tokens.withColumn("e", chosen)
        .where(F.col("e").isNotNull())
        .where(bits >= LEAST_BITS)
        .withColumn(
            "v",
            F.transform(
                F.filter(F.split("e.body", ""), lambda c: c != ""),
                lambda c: F.instr(F.col("e.alphabet"), c) - 1,
            ),
        )
    )
    total = F.lit(0.0)
    n, k = F.size("v").cast("double"), F.col("e.k").cast("double")
    squares = F.aggregate(
        F.sequence(F.lit(0), F.col("e.k") - 1),
        total,
        lambda done, value: done + F.pow(F.size(F.filter("v", lambda x: x == value)), F.lit(2.0)),
    )
    next_to = F.zip_with(
        F.slice("v", F.lit(1), F.size("v") - 1),
        F.slice("v", F.lit(2), F.size("v") - 1),
        lambda a, b: F.struct(a.alias("a"), b.alias("b")),
    )
    middle = k / 2
    mean = F.aggregate("v", total, lambda done, x: done + x) / n
    rows = rows.withColumns(
        {
            "squares": squares,
            "high": F.size(F.filter("v", lambda x: x >= middle)).cast("double"),
            "turns": F.size(
                F.filter(next_to, lambda x: (x["a"] >= middle) != (x["b"] >= middle))
            ).cast("double"),
            "mean": mean,
        }
    )
    m = F.col("mean")
    spread = F.aggregate("v", total, lambda done, x: done + F.pow(x - m, F.lit(2.0)))
    product = F.aggregate(next_to, total, lambda done, x: done + (x["a"] - m) * (x["b"] - m))
    chi = F.col("squares") * k / n - n
    # Two classes with one degree of freedom, or three with two.
    small, capital, other = _class_counts()
    letters = F.when(F.col("e.name") == "base64", small).otherwise(small + capital)
    between = F.lit(0.0)
    for place, count in enumerate((letters, capital, other)):
        share = F.lit(None)
        for name, of, _, alphabet in ENCODINGS:
            if CLASSES[name][place]:
                share = F.when(F.col("e.name") == name, CLASSES[name][place] / len(alphabet)).otherwise(share)
        between = between + F.coalesce(F.pow(count - n * share, F.lit(2.0)) / (n * share), F.lit(0.0))
    free = F.when(F.col("e.name") == "base64", 2).otherwise(1)
    p_between = F.when(F.col("e.name") == "base64", F.exp(-between / 2)).otherwise(
        _two_sided(F.sqrt(between))
    )
    z_chi = (chi - between - (k - 1 - free)) / F.sqrt(2 * (k - 1 - free) * (n - 1) / n)
    high, low = F.col("high"), n - F.col("high")
    both = 2 * high * low
    z_runs = (F.col("turns") + 1 - (both / n + 1)) / F.sqrt(both * (both - n) / (n * n * (n - 1)))
    p_runs = F.when(both > n, _two_sided(z_runs)).otherwise(F.lit(1e-12))
    p_serial = F.when(
        spread > 0, _two_sided((product / spread + 1 / n) * F.sqrt(n))
    ).otherwise(F.lit(1e-12))
    p_between = F.greatest(p_between, F.lit(1e-300))
    half = -(F.log(_upper(z_chi)) + F.log(p_between) + F.log(p_runs) + F.log(p_serial))
    # Chi-squared with eight degrees of freedom has this tail.
    fisher = F.exp(-half) * (1 + half + half * half / 2 + half * half * half / 6)
    return rows.withColumns(
        {"encoding": F.col("e.name"), "length": n, "p_random": fisher}
    ).drop("e", "v", "squares", "high", "turns", "mean")


# Thresholds that are tried, and the shortest lengths of the classes.
TRIED = (0.02, 0.05, 0.1, 0.2, 0.3, 0.5)
LENGTHS = (0, 20, 24, 28, 32)
# How often capitalised words put together, with a digit, reach each threshold, by class:
# measured on 12,000 made-up names of each length, rounded up. No share is taken as less
# than one in ten thousand.
ORDINARY = (
    (0.5, 0.35, 0.22, 0.1, 0.045, 0.006),
    (0.24, 0.13, 0.05, 0.01, 0.0025, 0.0002),
    (0.07, 0.02, 0.003, 0.0002, 0.0001, 0.0001),
    (0.006, 0.0007, 0.0001, 0.0001, 0.0001, 0.0001),
    (0.0005, 0.0001, 0.0001, 0.0001, 0.0001, 0.0001),
)


def length_class(length: Column) -> Column:
    """The number of the class of lengths: longer strings are told apart better."""
    return sum(((length >= least).cast("int") for least in LENGTHS[1:]), F.lit(0))


def fit_thresholds(tested: DataFrame, false_discoveries: float = 0.05) -> dict[int, float]:
    """For each class of lengths, the p from which a string counts as random.

    A discovery is a string taken for a random one, a false one an ordinary string
    among them. Benjamini and Hochberg's rule per class: the least p is taken at which
    the ordinary strings that reach it by chance, as many as ORDINARY says of those that
    do not reach it, are at most the share `false_discoveries` of all that reach it. The
    p of random strings is spread evenly, so twice the strings above one half says how
    many they are; where more reach p than these explain, by three standard deviations,
    the ordinary strings are not of the kind that was measured, and a larger p is taken.
    All distinct strings count; a few numbers per class come to the driver.
    """
    distinct = tested.groupBy("token").agg(
        F.first("p_random").alias("p_random"), F.first("length").alias("length")
    )
    above = [F.count(F.when(F.col("p_random") >= p, 1)).alias(f"above{i}") for i, p in enumerate(TRIED)]
    counts = distinct.groupBy(length_class(F.col("length")).alias("class")).agg(F.count(F.lit(1)).alias("n"), *above)
    found = {}
    for row in counts.collect():
        random = 2 * row[f"above{len(TRIED) - 1}"]
        for i, (p, share) in enumerate(zip(TRIED, ORDINARY[row["class"]], strict=True)):
            reached = row[f"above{i}"]
            false = (row["n"] - reached) * share / (1 - share)
            unexplained = reached * (1 - false_discoveries) - random * (1 - p)
            if reached and false <= false_discoveries * reached and unexplained <= 3 * (random + 1) ** 0.5:
                found[row["class"]] = p
                break
    return found


def _in_chunks(known: Column) -> Column:
    """Spans by start, in chunks with their least start and largest end."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(known), F.lit(1)), F.lit(_CHUNK))
    chunks = F.transform(starts, lambda at: F.slice(known, at, F.lit(_CHUNK)))
    return F.transform(
        chunks,
        lambda chunk: F.struct(
            F.array_min(F.transform(chunk, lambda x: x["start"])).alias("start"),
            F.array_max(F.transform(chunk, lambda x: x["end"])).alias("end"),
            chunk.alias("chunk"),
        ),
    )


def _without_overlaps(chunks: Column) -> Column:
    """Candidates that touch none of the spans in `chunks`."""

    def touch(a: Column, b: Column) -> Column:
        return F.coalesce((a["start"] < b["end"]) & (b["start"] < a["end"]), F.lit(False))

    return F.filter(
        "candidates",
        lambda c: ~F.exists(chunks, lambda x: touch(x, c) & F.exists(x["chunk"], lambda s: touch(s, c))),
    )


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id and `secrets`: start, end, kind and value of each, in order.

    Kinds `assign`, `access` and `hex` are known forms. `random` are runs of
    encoding characters that the battery of `with_randomness` cannot tell from
    random ones, with the thresholds that `fit_thresholds` sets over all documents;
    they are added where they touch no known form. Digits alone and letters of one
    case alone are no encoding. Known forms that overlap each other all stay.

    A null text is empty. Every row gives a row, in which nothing found is an empty
    array; rows with equal doc_id and text get equal arrays. Other columns are not
    looked at. An empty table gives none.

    Texts are read once and never shuffled: what is stored per document are its
    spans and candidate strings.
    """
    text = F.col("text")
    rows = docs.select("doc_id", whole(text).alias("text"))
    stored = pin(
        rows.select(
            "doc_id",
            F.xxhash64("text").alias("text_hash"),
            known_forms(text).alias("known"),
            spans(text, CANDIDATE).alias("candidates"),
        )
    ).df
    apart = _bound(_in_chunks(F.col("known")), _without_overlaps)
    tokens = stored.select("doc_id", "text_hash", F.explode(apart).alias("span")).withColumn(
        "token", F.col("span.value")
    )
    # Stored, so that the tests are planned and run once.
    tested = pin(with_randomness(tokens)).df
    least = F.lit(2.0)
    for number, p in fit_thresholds(tested).items():
        least = F.when(length_class(F.col("length")) == number, p).otherwise(least)
    random = (
        tested.where(F.col("p_random") >= least)
        .groupBy("doc_id", "text_hash")
        .agg(_of_kind(F.collect_set("span"), "random").alias("random"))
        .select(F.col("doc_id").alias("in_doc"), F.col("text_hash").alias("in_text"), "random")
    )
    same = (F.col("text_hash") == F.col("in_text")) & F.col("doc_id").eqNullSafe(F.col("in_doc"))
    return stored.join(random, same, "left").select(
        "doc_id",
        "known",
        F.when(F.col("random").isNull(), F.col("known"))
        .otherwise(F.array_sort(F.concat("known", "random")))
        .alias("secrets"),
    )


def _joined(found: Column | str) -> Column:
    return F.array_join(
        F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
    )


def query(spark, sf_dir) -> DataFrame:
    def count(kind: str) -> Column:
        found = F.filter("known", lambda x: x["kind"] == kind)
        return F.size(found).cast("long").alias(f"n_{kind}")

    return find_secrets(documents(spark, sf_dir)).select(
        "doc_id",
        *map(count, KINDS[:3]),
        F.sha2(_joined("known"), 256).alias("base_sha256"),
        _joined("secrets").alias("spans"),
    )
