"""Secret scans with DataFrame functions only: patterns plus sliding-window entropy with an allow-list.

Base kinds are found by their patterns. The method adds candidate strings: maximal runs of
`[A-Za-z0-9+/_=-]` of 20 to 4096 characters, or longer. A window of 20 characters slides over a candidate; for its
character class (hex digits, letters of both cases, or letters of one case; the last two with the other base-64 characters) it keeps counts that change by one
character in and one out, and with them the sum of c log2 c, so a step doesn't count the window again. A candidate
whose largest window entropy reaches the class's threshold is a span, unless the allow-list suppresses
it: no digit (words and paths of words), only digits, letters of one case that meet a digit fewer than
twice (words with dates and numbers), UUIDs, runs of one alphabet in order, or a
placeholder word inside. The allow-list never suppresses a base span.

Positions are code points, ends exclusive. A null text counts as empty and has no span. Texts are
scanned whole; there is no shuffle. Repeated rows give repeated results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import attach

#: The base kinds in the order in which spans of one start are listed, with their patterns.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"  # AKIA[A-Z0-9]+ of 16 characters or more: runs are maximal
HEX = r"[0-9a-f]{32,}"  # [0-9a-f]+ of 32 characters or more
#: What each match of ASSIGN has in it: a keyword's last letter before the sign. Cheaper to look for.
BEFORE_VALUE = r"""[dDtTnNyY]["']?\x20*[:=]"""
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64", "entropy_single")
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"

#: Fixed values of the allow-list.
UUID = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
PLACEHOLDER = r"(?i)example|placeholder|changeme|redacted|dummy|xxxx|lorem|0123456789|abcdefgh|12345678"

WINDOW = 20
#: Bits of entropy in a window of 20 from which a candidate counts.
LEAST_BITS = {"entropy_hex": 2.9, "entropy_base64": 3.7, "entropy_single": 3.3}
#: Where a letter and a digit meet. Words, dates and numbers between separators have few such places, random strings many.
MEET = r"(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])"
LEAST_MEETS = 2


def _pieces(text: Column, pattern: str) -> Column:
    """Matches as structs (start, end): the pieces between matches and the matches, laid end to end."""
    between = F.transform(F.split(text, pattern, -1), F.length)
    matched = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))
    return F.aggregate(
        F.arrays_zip(between.alias("b"), matched.alias("m")),
        start,
        lambda acc, x: F.when(x["m"].isNull(), acc).otherwise(
            F.struct(
                (acc["at"] + x["b"] + x["m"]).alias("at"),
                F.array_append(acc["out"], F.struct((acc["at"] + x["b"]).alias("start"), (acc["at"] + x["b"] + x["m"]).alias("end"))).alias("out"),
            )
        ),
        lambda acc: acc["out"],
    )


_NONE = "array<struct<start:int,end:int>>"


def _found(text: Column, pattern: str) -> Column:
    """Only a text with a match is cut into pieces."""
    return F.when(text.rlike(pattern), _pieces(text, pattern)).otherwise(F.array().cast(_NONE))


def _assigned(text: Column) -> Column:
    """Matches of ASSIGN whose value has eight characters or more."""
    value = F.transform(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(1)), F.length)
    both = F.arrays_zip(_pieces(text, ASSIGN).alias("span"), value.alias("size"))
    likely = (text.contains(":") | text.contains("=")) & text.rlike(BEFORE_VALUE) & text.rlike(ASSIGN)
    return F.when(likely, F.transform(F.filter(both, lambda x: x["size"] >= 8), lambda x: x["span"])).otherwise(F.array().cast(_NONE))


def _c_log_c(c: Column) -> Column:
    return F.when(c > 1, c * F.log2(c)).otherwise(F.lit(0.0))


def _once(value: Column, use) -> Column:
    """use(value), with value evaluated once though used several times."""
    return F.transform(F.array(value), use)[0]


def window_entropy(word: Column, window: int = WINDOW) -> Column:
    """The largest Shannon entropy, in bits per character, of any window of the word.

    Counts by character sit in an array of 128; a step changes two of them and the sum of c log2 c.
    """
    return _once(F.filter(F.transform(F.split(word, ""), F.ascii), lambda c: c > 0), lambda codes: _largest(codes, window))


def _largest(codes: Column, window: int) -> Column:
    zero = F.struct(F.array_repeat(F.lit(0), 128).alias("counts"), F.lit(0.0).cast("double").alias("sum"), F.lit(0.0).cast("double").alias("best"))

    def changed(acc: Column, code: Column, by: int) -> Column:
        """acc after one character came (by 1) or went (by -1)."""
        n = acc["counts"][code].cast("double")
        return F.struct(
            F.transform(acc["counts"], lambda c, i: F.when(i == code, c + by).otherwise(c)).alias("counts"),
            (acc["sum"] - _c_log_c(n) + _c_log_c(n + by)).alias("sum"),
            acc["best"].alias("best"),
        )

    def slide(acc: Column, i: Column) -> Column:
        come = changed(acc, codes[i], 1)
        both = _once(come, lambda x: F.when(i < window, x).otherwise(changed(x, codes[i - window], -1)))
        full = F.lit(window * math.log2(window))
        return _once(both, lambda x: F.when(i < window - 1, x).otherwise(F.struct(x["counts"].alias("counts"), x["sum"].alias("sum"), F.greatest(x["best"], full - x["sum"]).alias("best"))))

    return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), zero, slide, lambda acc: acc["best"] / F.lit(float(window)))


def _suspicious(word: Column) -> Column:
    """The entropy kind of a candidate string, null where it is none or is allowed."""
    allowed = ~word.rlike("[0-9]") | ~word.rlike("[A-Za-z]") | word.rlike(UUID) | word.rlike(PLACEHOLDER)
    is_hex = word.rlike("^([0-9a-f]+|[0-9A-F]+)$")
    single = ~is_hex & ~(word.rlike("[A-Z]") & word.rlike("[a-z]"))
    parted_hex = word.rlike("^([0-9a-f+/_=-]+|[0-9A-F+/_=-]+)$")
    least = F.when(is_hex | (single & parted_hex), LEAST_BITS["entropy_hex"]).when(single, LEAST_BITS["entropy_single"]).otherwise(LEAST_BITS["entropy_base64"])
    allowed = allowed | (single & (F.regexp_count(word, F.lit(MEET)) < LEAST_MEETS))
    kind = F.when(is_hex, KINDS.index("entropy_hex")).when(single, KINDS.index("entropy_single")).otherwise(KINDS.index("entropy_base64"))
    bits = F.when(allowed, F.lit(0.0)).otherwise(window_entropy(word))
    return F.when(bits >= least, kind)


def _entropic(text: Column) -> Column:
    words = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    told = F.transform(F.arrays_zip(_pieces(text, CANDIDATE).alias("span"), words.alias("word")), lambda x: F.struct(x["span"]["start"].alias("start"), _suspicious(x["word"]).alias("kind"), x["span"]["end"].alias("end")))
    likely = text.rlike("[0-9]") & text.rlike(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20}")
    return F.when(likely, F.filter(told, lambda x: x["kind"].isNotNull())).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int>>"))


def _listed(spans: Column) -> Column:
    """kind:start:end of each, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", names[x["kind"]], x["start"].cast("string"), x["end"].cast("string"))), ",")


SPAN = "array<struct<start:int,kind:int,end:int>>"


def scan(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Rows of docs (columns `keep`, by default all) with secrets (array of start, kind number, end, in order),
    n_assign, n_access, n_hex, n_entropy, base_sha256 and spans; inputs of these names are replaced.
    """
    made = ["secrets", "n_assign", "n_access", "n_hex", "n_entropy", "base_sha256", "spans"]
    names = attach(docs.columns if keep is None else keep, made)
    t = F.col("_text")
    rows = docs.select(*names, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = rows.withColumns({"_assign": _assigned(t), "_access": F.when(t.contains("AKIA"), _found(t, ACCESS)).otherwise(F.array().cast(_NONE)), "_hex": _found(t, HEX), "_more": _entropic(t)})

    def of(column: str, kind: str) -> Column:
        return F.transform(F.col(column), lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), x["end"].alias("end")))

    rows = rows.withColumn("_base", F.array_sort(F.concat(of("_assign", "assign"), of("_access", "access"), of("_hex", "hex"))).cast(SPAN))
    return rows.select(
        *names,
        F.array_sort(F.concat("_base", F.col("_more").cast(SPAN))).alias("secrets"),
        F.size("_assign").cast("bigint").alias("n_assign"),
        F.size("_access").cast("bigint").alias("n_access"),
        F.size("_hex").cast("bigint").alias("n_hex"),
        F.size("_more").cast("bigint").alias("n_entropy"),
        F.sha2(_listed(F.col("_base")), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat("_base", F.col("_more").cast(SPAN)))).alias("spans"),
    )


def redact(docs: DataFrame, *, text: str = "text", mark: str = "[REDACTED]") -> DataFrame:
    """docs, in its own columns, with each secret of the text replaced by the mark; overlapping spans count as one.

    Texts without a secret, nulls among them, stay as they are, and so do all other columns, whatever their names.
    """
    found = scan(docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col(text).alias("_whole")), text="_whole", keep=["_row", "_whole"])
    merged = F.aggregate(
        F.col("secrets"),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda acc, x: F.when(x["end"] <= acc["at"], acc).otherwise(
            F.struct(
                x["end"].alias("at"),
                F.when((x["start"] < acc["at"]) & (acc["at"] > 0), acc["out"])
                .otherwise(F.concat(acc["out"], F.array(F.substring(F.col("_whole"), acc["at"] + 1, x["start"] - acc["at"]), F.lit(mark))))
                .alias("out"),
            )
        ),
        lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(F.col("_whole"), acc["at"] + 1, F.length("_whole"))),
    )
    clean = F.when(F.size("secrets") > 0, merged).otherwise(F.col("_whole"))
    return found.withColumn("_clean", clean).select(*((F.col("_clean") if c == text else F.col("_row").getField(c)).alias(c) for c in docs.columns))
