"""Per-document text quality statistics (problem 10).

Statistics of words, symbols and lines are counted over whole columns of texts. Their distributions per language are kept as
mergeable quantile sketches (counts per bin), in which equal texts count once, so that copies can't shift what is usual. A
document's values become robust z-scores against its language and against the whole corpus; documents in a tail are looked
at. Of these, each line is read as prose, list item, row of values or junk, and those of which more than half is no natural
prose come out, with the kind that takes up most. A document in no tail of the statistics never comes out.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmark.session import cut

#: The statistics and the side on which a tail speaks against natural prose (0: none, the statistic is only reported).
SIDES = {
    "n_words": 0, "words_per_line": 0, "end_punct_share": 0, "mean_word": 2, "longest_word": 1, "symbol_ratio": 1, "digit_ratio": 1, "delimiter_ratio": 1,
    "markup_ratio": 1, "item_share": 1, "damaged_ratio": 1, "cluster_ratio": 1, "common_share": -1, "distinct_share": -1,
}
STATS = list(SIDES)
_LOGARITHMIC = {"n_words", "words_per_line", "mean_word", "longest_word"}  # binned by their logarithm, the others as they are
TAIL = 3.0  # robust z beyond which a value is in the tail
QS = [0.005, 0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 0.995]
KINDS = ("prose", "list", "table", "junk")

# Very common words of the languages expected.
COMMON = {
    "en": "the of and to a in is was it for on that with as at by be this from or are were not an but they which we has have had its his her you he she i no so if there been when will would their more than all after before until our do did out up can could into who what about some any only also because then them",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si sin sobre este ya entre cuando todo esta ser son dos también fue había era muy años hasta desde está porque nos",
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec à son sa ses elle ou mais nous vous être cette ont été aux comme on a je leur y avant après très",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man wurde wir bitte",
}
_COMMON = frozenset(w for ws in COMMON.values() for w in ws.split())

_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_BULLET = re.compile(r"\s*(?:[-*+•‣◦▪●–·>o]|\(?\d{1,3}[.)]|\(?[a-zA-Z][.)]|\(?[ivx]{1,4}[.)]|\[[ xX]?\]|[☐☑✓✔])\s+\S")
# Possessive and between delimiters, so that the time stays in proportion to the line without a limit on what lies between them.
_TAG = re.compile(r"</?[a-zA-Z][^<>]*+>|&[a-z]{2,6};")
_CSS = re.compile(r"(?<![\w-])[.#]?[\w-]++\s*+\{[^{}]*+\}|\{\{[^{}]*+\}\}|(?<![\w-])[\w-]++\(\)\s*+;|\bfunction\s*+\(")
_CELL = re.compile(r"</?(?:t[rdh]|table|thead|tbody)\b[^<>]*+>", re.I)
_MOJIBAKE = re.compile("[Â-ô][\u0080-¿]|[ÃÂâÐÑØÙ][\u0080-¿€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]")
_NOISE = regex.compile(r"[^\p{L}\p{M}\p{N}\s.,;:!?'\"()\-–—/%&$€£°’‘“”«»¿¡。，、；：？！（）「」…،؛؟·]")
_PLAIN_NOISE = re.compile(r"[^\w\s.,;:!?'\"()\-/%&$]|_")  # the same for ASCII
_OTHER_SCRIPT = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}\p{Arabic}\p{Hebrew}\p{Thai}]")
_VALUE = re.compile(r"[-+$€£]?\d[\d.,:/%\-]*\s?\w{0,4}|[A-Za-z]?\d*[A-Z]{1,4}\d*\w{0,8}|[A-Z0-9_\-]{2,12}|[a-z]{1,8}|-|")
_LONG = re.compile(r"[A-Za-z0-9+/=_\-]{40,}")
_CLUSTER = re.compile(r"[bcdfghjklmnpqrstvwxz]{4}")
_NUMBERISH, _NO_DIGIT = re.compile(r"\d"), re.compile(r"\D+")
_STOP, _MARK, _WORDY = re.compile(r"[.!?:]\s*$"), re.compile(r"[.!?,;:]"), re.compile(r"[a-z]{3}")


def _noise(text: str) -> int:
    """Characters that are neither letters, digits, blanks nor usual marks."""
    return len((_PLAIN_NOISE if text.isascii() else _NOISE).findall(text))


def _fields(line: str) -> tuple[str, list[str]]:
    mark = max("\t|;,", key=line.count)
    if line.count(mark) >= 2:
        return mark, [x.strip() for x in line.strip().strip("|").split(mark)]
    gaps = [x for x in re.split(r"\s{2,}", line.strip())]
    return ("  ", gaps) if len(gaps) >= 3 else ("", [])


def _line(line: str) -> str:
    """The kind of one line: p prose, l list, t row of values, j junk, s short (decided by its neighbours)."""
    n = len(line)
    words = _WORD.findall(line)
    loud = line.isupper()
    common = sum(w.lower() in _COMMON and (loud or len(w) != 2 or not w.isupper()) for w in words)  # AM, NA and the like are values
    letters = sum(map(len, words))
    if not line.isascii():
        if len(_MOJIBAKE.findall(line)) * 2 > 0.12 * n:
            return "j"
        if len(_OTHER_SCRIPT.findall(line)) > 0.25 * n:
            return "l" if _BULLET.match(line) else "p"
    if "<" in line and _CELL.search(line):
        return "t"
    marked = sum(map(len, _TAG.findall(line))) if "<" in line or "&" in line else 0
    if "{" in line or "(" in line:
        marked += sum(map(len, _CSS.findall(line)))
    if marked > 0.3 * n:
        return "j"
    if max(map(len, line.split()), default=0) >= 40 and sum(map(len, _LONG.findall(line))) > 0.5 * n:
        return "j"
    mark, fields = _fields(line)
    noise = _noise(line)
    if mark == "|" and noise - line.count("|") <= 0.05 * n and (re.match(r"\s*\|.*\|\s*$", line) or line.count(" | ") >= 2):
        return "t"
    if letters < 0.2 * n and not _NUMBERISH.search(line):
        return "j"
    if n >= 20 and noise > (0.12 if _BULLET.match(line) else 0.07) * n:
        return "j"
    if mark in ("\t", "  ") and common <= 0.2 * len(words) and len(line.split()) <= 3.5 * len(fields):
        return "t"
    if _BULLET.match(line):
        return "l"
    if mark in (",", ";") and len(fields) >= 3 and common <= 0.12 * max(len(words), 1):
        values = sum(bool(_VALUE.fullmatch(x)) for x in fields)
        numbers = sum(bool(_NUMBERISH.search(x)) and not _WORDY.search(x) for x in fields)
        if values >= 0.6 * len(fields) and (numbers >= 0.25 * len(fields) or len(fields) <= 12):
            return "t"
        if max(len(x) for x in fields) <= 60:
            return "m"
    if len(words) >= 8 and sum(len(w) <= 4 for w in words) <= 0.05 * len(words) and not _MARK.search(line) and letters > 0.8 * n:
        return "j"
    if len(words) >= 9 and common <= 0.05 * len(words) and not _MARK.search(line) and letters > 0.8 * n:
        return "j"
    if len(words) >= 8 and common <= 0.15 * len(words) and sum(bool(_CLUSTER.search(w)) for w in words) > 0.2 * len(words):
        return "j"
    if common >= 1 and (len(words) >= 6 or _STOP.search(line)):
        return "p"
    if len(words) >= 9:
        return "p"
    return "s"


def _repeated(block: str) -> bool:
    """Whether most of the block says the same again and again: few distinct five-grams in most pieces of 120 units."""
    units = block.split()
    if len(units) * 25 < len(block):  # hardly any spaces: characters are the units
        units = [c for c in block if not c.isspace()]
    pieces = [units[i : i + 120] for i in range(0, len(units), 120)]
    again = whole = 0
    for x in pieces:
        grams = list(zip(x, x[1:], x[2:], x[3:], x[4:]))
        if len(grams) >= 10:
            whole += len(x)
            again += len(x) * (len(set(grams)) <= 0.35 * len(grams))
    return again * 2 > max(whole, 1) and whole * 2 > len(units)


def _repeats(text: str) -> bool:
    """Whether most of the whole text is copied from earlier in it, at any period and across blank lines.

    Few distinct five-grams alone don't show that, as long prose of stock sentences has few too; they must also recur in long
    stretches at one distance, which is what a mechanical copy does.
    """
    units, least = text.split(), 20
    if len(units) * 25 < len(text):
        units, least = [c for c in text if not c.isspace()], 100
    grams = list(zip(units, units[1:], units[2:], units[3:], units[4:]))
    if len(grams) < 10 or len(set(grams)) > 0.35 * len(grams):
        return False
    last: dict = {}
    copied = run = distance = 0
    for i, g in enumerate(grams):
        back = i - last.get(g, i)
        last[g] = i
        if back != distance:
            copied += run * (run >= least)
            run, distance = 0, back
        run += back > 0
    return copied + run * (run >= least) >= 0.65 * len(grams)


def line_kinds(text: str) -> dict[str, int]:
    """Characters of the text (white space at the ends of lines left out) per kind."""
    share = dict.fromkeys(KINDS, 0)
    if _repeats(text):
        share["junk"] = sum(len(x.strip()) for x in text.splitlines())
        return share
    for block in re.split(r"\n[ \t\r\f\v]*\n", text):
        lines = [x.rstrip() for x in block.splitlines()]
        lines = [x for x in lines if x.strip()]
        if not lines:
            continue
        size = [len(x.strip()) for x in lines]
        total = sum(size)
        if _repeated(block):
            share["junk"] += total
            continue
        kinds = [_line(x) for x in lines]
        # several lines of one delimiter and one number of fields are rows
        rows = [(_fields(x)[0], len(_fields(x)[1])) for x in lines]
        for i, k in enumerate(kinds):
            if k in "ms":
                near = [rows[j] for j in (i - 1, i + 1) if 0 <= j < len(lines)]
                if rows[i][0] in (",", ";", "\t") and rows[i] in near and (len(lines) > 2 or rows[i][1] >= 4):
                    kinds[i] = "t"
        kinds = ["l" if k == "m" else k for k in kinds]
        # short lines: part of prose that is broken into lines, titles, or items without a mark
        solid = [k for k in kinds if k != "s"]
        short = kinds.count("s")
        for i, k in enumerate(kinds):
            if k == "s":
                near = [kinds[j] for j in (i - 1, i + 1) if 0 <= j < len(kinds) and kinds[j] != "s"]
                if solid and len(solid) >= short:
                    kinds[i] = near[0] if near else max(set(solid), key=solid.count)
                elif len(lines) >= 3:
                    kinds[i] = "l"
                else:
                    kinds[i] = "p"
        for k, n in zip(kinds, size):
            share[{"p": "prose", "l": "list", "t": "table", "j": "junk"}[k]] += n
    return share


def check_kind(text: str) -> str | None:
    """The kind that takes up most of a text of which more than half is no prose, else None."""
    share = line_kinds(text)
    if share["prose"] * 2 >= sum(share.values()):
        return None
    return max(KINDS[1:], key=lambda k: (share[k], k))


def _check(batches):
    for b in batches:
        kinds = [check_kind(x) for x in b["_text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(kinds, pa.string())], names=["doc_id", "kind"])


def language(c: Column | str) -> Column:
    """The two-letter language in lower case ('en-US' and 'EN' are en), 'und' if there is none: at most 677 values."""
    c = F.lower(F.substring(F.col(c) if isinstance(c, str) else c, 1, 2))
    return F.when(c.rlike("^[a-z]{2}$") & (c != "un"), c).otherwise(F.lit("und"))


# Patterns of the statistics, for a linear-time matcher over whole columns of texts.
_MARKS = r"[^\pL\pM\pN\s.,;:!?'\"()\-–—/%&$€£°’‘“”«»¿¡。，、；：？！（）「」…،؛؟·]"
_ITEM = r"(?m)^[ \t]*(?:[-*+•‣◦▪●–·>o]|\(?\d{1,3}[.)]|\(?[a-zA-Z][.)]|\(?[ivx]{1,4}[.)]|\[[ xX]?\]|[☐☑✓✔])[ \t]+[^\s]"
_ENDED = "(?m)[.!?:;。！？؟…\"'”)][ \\t]*$"
_KNOWN = r"\b(?:" + "|".join(sorted(_COMMON, key=len, reverse=True)) + r")\b"


def _spread(low: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct blank-separated words, length of the longest, number) of each text."""
    words = pc.utf8_split_whitespace(low)
    owner, flat = np.repeat(np.arange(len(words)), np.diff(words.offsets.to_numpy())), words.values
    flat = flat.slice(words.offsets[0].as_py(), len(owner)).dictionary_encode()
    used = np.unique(owner * max(len(flat.dictionary), 1) + flat.indices.to_numpy()) // max(len(flat.dictionary), 1) if len(owner) else owner
    longest = np.zeros(len(words))
    np.maximum.at(longest, owner, pc.utf8_length(flat.dictionary).to_numpy()[flat.indices.to_numpy()] if len(owner) else 0)
    return np.bincount(used.astype("int64"), minlength=len(words)), longest, np.bincount(owner, minlength=len(words))


def measures(texts: pa.Array, which: tuple[str, ...] = tuple(STATS)) -> dict[str, np.ndarray]:
    """The statistics of each text, NaN for null, empty and blank ones."""
    blank = pc.fill_null(pc.equal(pc.utf8_length(pc.utf8_trim_whitespace(texts)), 0), True).to_numpy(zero_copy_only=False)
    texts = pc.fill_null(texts, "")
    low = pc.utf8_lower(texts)
    count = lambda pattern, t=texts: pc.count_substring_regex(t, pattern).to_numpy(zero_copy_only=False).astype(float)
    size = np.maximum(pc.utf8_length(texts).to_numpy(zero_copy_only=False), 1)
    n_words = count(r"\pL+(?:['’]\pL+)*") if set(which) & {"n_words", "words_per_line", "mean_word", "cluster_ratio", "common_share"} else None
    few = np.maximum(n_words, 1) if n_words is not None else None
    lines = np.maximum(count(r"(?m)^.*[^\s]"), 1) if set(which) & {"words_per_line", "end_punct_share", "item_share"} else None
    distinct, longest, tokens = _spread(low) if set(which) & {"distinct_share", "longest_word"} else (None, None, None)
    make = {
        "n_words": lambda: n_words, "words_per_line": lambda: n_words / lines, "end_punct_share": lambda: count(_ENDED) / lines,
        "mean_word": lambda: pc.utf8_length(pc.replace_substring_regex(texts, r"[^\pL]+", "")).to_numpy(zero_copy_only=False) / few,
        "longest_word": lambda: longest, "symbol_ratio": lambda: count(_MARKS) / size, "digit_ratio": lambda: count(r"\pN") / size, "delimiter_ratio": lambda: count(r"[\t|;]|,[^\s]| {2,}[^\s]") / size,
        "markup_ratio": lambda: count(r"[<>{}]|&[a-z]{2,6};") / size, "item_share": lambda: count(_ITEM) / lines, "damaged_ratio": lambda: count(_MOJIBAKE.pattern) / size,
        "cluster_ratio": lambda: count(_CLUSTER.pattern, low) / few, "common_share": lambda: count(_KNOWN, low) / few, "distinct_share": lambda: distinct / np.maximum(tokens, 1),
    }
    return {k: np.where(blank, np.nan, make[k]()) for k in which}


def document_statistics(docs: DataFrame, text: str = "text", lang: str = "lang", keep: tuple[str, ...] = (), which: tuple[str, ...] = tuple(STATS)) -> DataFrame:
    """doc_id, keep..., lang, text_hash and the statistics (`which`) of each document; null statistics for null, empty and blank texts.

    Whole texts, measured a column at a time; no shuffle. "_text" in keep is the text.
    """
    rows = docs.select("doc_id", *(c for c in keep if c != "_text"), language(lang).alias("lang"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("_text"))
    kept = ["doc_id", *keep, "lang", "text_hash"]

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 2_000):
                part = b.slice(i, 2_000)
                got = measures(part["_text"], which)
                yield pa.RecordBatch.from_arrays([*(part[c] for c in kept), *(pa.array(x, pa.float64(), from_pandas=True) for x in got.values())], names=[*kept, *got])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*kept).schema)
    return rows.mapInArrow(run, f"{kinds}, " + ", ".join(f"{s} double" for s in which))


def _of(df: DataFrame) -> list[str]:
    return [s for s in STATS if s in df.columns]


def _bin(c: str) -> Column:
    x = F.log1p(F.col(c)) * 64 if c in _LOGARITHMIC else F.col(c) * 512
    return F.floor(x).cast("int")


def _unbin(statistic: Column, b: Column) -> Column:
    """The middle of a bin: within 0.8 % of a logarithmic statistic plus one, within 0.001 of the others."""
    return F.when(statistic.isin(*sorted(_LOGARITHMIC)), F.expm1((b + 0.5) / 64)).otherwise(F.when(b == 0, 0.0).otherwise((b + 0.5) / 512))


def statistic_sketches(stats: DataFrame) -> DataFrame:
    """(lang, statistic, bin, n): counts per bin of the statistics of distinct texts. Sketches of several parts are merged by merge_sketches."""
    names = _of(stats)
    texts = stats.where(F.col(names[0]).isNotNull()).select("lang", "text_hash", F.array(*(_bin(s) for s in names)).alias("bins")).dropDuplicates(["lang", "text_hash"])
    pairs = F.explode(F.array(*(F.struct(F.lit(s).alias("statistic"), F.col("bins")[i].alias("bin")) for i, s in enumerate(names))))
    return texts.select("lang", pairs.alias("x")).groupBy("lang", "x.statistic", "x.bin").agg(F.count("*").alias("n"))


def merge_sketches(*sketches: DataFrame) -> DataFrame:
    """One sketch of several; a text that is in more than one of them counts in each."""
    both = sketches[0]
    for s in sketches[1:]:
        both = both.unionByName(s)
    return both.groupBy("lang", "statistic", "bin").agg(F.sum("n").alias("n"))


def sketch_quantiles(sketch: DataFrame, qs: list[float] = QS) -> DataFrame:
    """(lang, statistic, n, at): the values at qs per language and statistic, from a sketch; bins per group are bounded by their widths."""
    own = Window.partitionBy("lang", "statistic")
    c = sketch.withColumn("upto", F.sum("n").over(own.orderBy("bin"))).withColumn("all", F.sum("n").over(own)).withColumn("v", _unbin(F.col("statistic"), F.col("bin")))
    at = [F.min(F.when(F.col("upto") >= F.ceil(F.col("all") * q), F.col("v"))) for q in qs]
    return c.groupBy("lang", "statistic").agg(F.max("all").alias("n"), F.array(*at).alias("at"))


def tail_references(sketch: DataFrame) -> DataFrame:
    """One row per language: lang, own and corpus (maps from a statistic to its middle and scale); at most 677 rows.

    The scale is the smaller distance of a quartile from the median, in standard deviations of a normal distribution, so that
    unnatural texts on one side don't widen it even where they are nearly half; with a floor for statistics that hardly vary.
    """
    usual = lambda s: sketch_quantiles(s, [0.25, 0.5, 0.75]).select("lang", "statistic", F.col("at")[1].alias("mid"), F.greatest(F.least(F.col("at")[2] - F.col("at")[1], F.col("at")[1] - F.col("at")[0]) / 0.6745, F.abs(F.col("at")[1]) * F.when(F.col("statistic") == "longest_word", 0.3).otherwise(0.05), F.lit(0.01)).alias("scale"))
    whole = usual(sketch.groupBy(F.lit("").alias("lang"), "statistic", "bin").agg(F.sum("n").alias("n"))).select("statistic", F.col("mid").alias("m2"), F.col("scale").alias("s2"))
    rows = usual(sketch).join(whole, "statistic")
    maps = [F.map_from_entries(F.collect_list(F.struct("statistic", F.struct(F.col(m).alias("mid"), F.col(s).alias("scale"))))) for m, s in (("mid", "scale"), ("m2", "s2"))]
    return rows.groupBy("lang").agg(maps[0].alias("own"), maps[1].alias("corpus"))


def robust_scores(stats: DataFrame, sketch: DataFrame) -> DataFrame:
    """stats with z_<statistic>: distance from the middle in scales, against the document's language and the whole corpus; the farther one counts.

    So languages of few documents, or of mostly unnatural ones, are judged too.
    """
    out = stats.join(F.broadcast(tail_references(sketch)), "lang", "left")  # one row per language
    z = lambda c, m: (F.col(c) - m[c]["mid"]) / m[c]["scale"]
    for c in _of(stats):
        a, b = z(c, F.col("own")), z(c, F.col("corpus"))
        out = out.withColumn(f"z_{c}", F.when(F.abs(a) >= F.abs(b), a).otherwise(b))
    return out.drop("own", "corpus")


def flag_tails(scores: DataFrame, tail: float = TAIL) -> DataFrame:
    """scores with `tails`: the names of the statistics that lie in a tail that speaks against natural prose."""
    beyond = lambda c: F.abs(c) > tail if SIDES[c[2:]] == 2 else F.col(c) * SIDES[c[2:]] > tail
    return scores.withColumn("tails", F.array_compact(F.array(*(F.when(beyond(f"z_{c}"), F.lit(c)) for c in _of(scores) if SIDES[c]))))


def unnatural_documents(docs: DataFrame, tail: float = TAIL, text: str = "text") -> DataFrame:
    """doc_id, kind of the documents in a tail of some statistic of which more than half is no natural prose.

    The measured texts are written to the shared folder once and read for the sketches (statistics only) and for the check;
    no text is shuffled. Null, empty and blank texts never come out; repeated texts and ids are judged alike; an empty table
    gives none.
    """
    measured = cut(document_statistics(docs, text, keep=("_text",)), "measured")
    sketch = cut(statistic_sketches(measured), "sketch")
    scored = flag_tails(robust_scores(measured, sketch), tail)
    return scored.where(F.size("tails") > 0).select("doc_id", "_text").mapInArrow(_check, "doc_id bigint, kind string").where("kind is not null")


WEIGHING = ("symbol_ratio", "digit_ratio", "common_share")


def with_weight(docs: DataFrame, keep: tuple[str, ...], text: str = "text", which: tuple[str, ...] = WEIGHING) -> DataFrame:
    """doc_id, keep..., _text and weight: 1 for a document in no tail of the statistics `which`, less the farther the farthest lies in one; 0.1 at least, also for blank texts."""
    measured = cut(document_statistics(docs, text, keep=(*keep, "_text"), which=which), "measured")
    scores = robust_scores(measured, cut(statistic_sketches(measured), "sketch"))
    far = [F.abs(f"z_{c}") if SIDES[c] == 2 else F.col(f"z_{c}") * SIDES[c] for c in which]
    weight = F.when(F.col(which[0]).isNull(), 0.1).otherwise(F.greatest(F.lit(0.1), TAIL / F.greatest(F.lit(TAIL), *far)))
    return scores.select("doc_id", *keep, "_text", weight.alias("weight"))


def label_agreement(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled documents per label and found kind. The line rules were revised against labelled documents, so this is held-out only on documents not used for that."""
    mine = docs.join(labels.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id")
    found = mine.join(unnatural_documents(docs), "doc_id", "left").withColumn("found", F.coalesce("kind", F.lit("prose")))
    return labels.select("doc_id", "label").join(found, "doc_id").groupBy("label", "found").agg(F.count("*").alias("n_docs"))


def profile(values: np.ndarray) -> list[float]:
    """Exact values at QS, for tests of the sketches."""
    return [float(np.quantile(values, q)) for q in QS]
