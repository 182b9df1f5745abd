"""Mixed timestamp texts to one UTC instant (problem 3).

A text is reduced to its shape mask (digits to 9, Latin letters to a, the rest as it is). Texts of one mask have one length
and their fields at the same places, so a mask is compiled once into field positions and the texts of a batch that share it
are converted together as a matrix of code points. Wall-clock times go through transition tables of their zone, built once
per process from a named release of the public tz database.

Defined cases: null, empty, blank, damaged, date-only and time-only texts, impossible dates, times, offsets, wall-clock
times that the zone skips or has twice, and texts that need an unknown zone or date order give no instant (null).
A text of any length is damaged if its mask fits no form.

A zone in a text may be an offset, an abbreviation with a fixed offset, UTC or GMT with an offset, or an IANA name. Beside an
offset, an IANA name in brackets must agree with it.
"""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmark.session import BLANKS, micros

LONG = 200  # masks of more characters aren't kept in the process's cache
_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Month and weekday names as written in the texts, zone abbreviations with their offset from UTC in minutes.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
LONG_MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
WEEKDAYS = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]
LONG_WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
ABBREVIATIONS = {
    "utc": 0, "gmt": 0, "z": 0, "ut": 0, "wet": 0, "west": 60, "bst": 60, "cet": 60, "cest": 120, "met": 60, "mest": 120, "eet": 120, "eest": 180,
    "msk": 180, "ast": -240, "adt": -180, "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420,
    "akst": -540, "akdt": -480, "hst": -600,
}

_CLOCK = r"(?P<H>99?):(?P<M>99)(?::(?P<S>99)(?:[.,](?P<f>9{1,9}))?)?(?: ?(?P<p>aa|a\.a\.)(?!a))?"
_NAME = r"a{2,}(?:/[a9_+-]+)+"
_ZONE = rf"(?: ?(?P<z>[+-]99(?::?99)?)(?: ?\[(?P<j>{_NAME})\])?| ?(?P<u>aaa ?[+-]99?(?::?99)?)| ?\[(?P<k>{_NAME})\]| ?(?P<i>{_NAME})| ?(?P<x>aa?a?a?))?"
_FORMS = [
    ("ymd", re.compile(rf"(?P<Y>9999)(?P<s>[-/.])(?P<m>99?)(?P=s)(?P<d>99?)[ a_] ?{_CLOCK}{_ZONE}")),
    ("num", re.compile(rf"(?P<A>99?)(?P<s>[-/.])(?P<B>99?)(?P=s)(?P<C>9999|99)[ a] ?{_CLOCK}{_ZONE}")),
    ("dby", re.compile(rf"(?:(?P<w>a{{3,9}}),? )?(?P<d>99?)[- ](?P<b>a{{3,9}})[- ,]+(?P<Y>9999)[ a] ?{_CLOCK}{_ZONE}")),
    ("bdy", re.compile(rf"(?:(?P<w>a{{3,9}}),? )?(?P<b>a{{3,9}}) (?P<d>99?),? (?P<Y>9999),? {_CLOCK}{_ZONE}")),
    ("run", re.compile(rf"(?P<Y>9999)(?P<m>99)(?P<d>99)(?P<t>[a ])?(?P<H>99)(?P<M>99)(?P<S>99)(?:[.,](?P<f>9{{1,9}}))?{_ZONE}")),
    ("run", re.compile(rf"(?P<Y>9999)(?P<m>99)(?P<d>99)(?P<t>a)(?P<H>99)(?P<M>99){_ZONE}")),
    ("ordinal", re.compile(rf"(?P<Y>9999)-(?P<n>999)(?P<t>[a ]){_CLOCK}{_ZONE}")),
    ("week", re.compile(rf"(?P<Y>9999)-(?P<q>a)(?P<n>99)-(?P<e>9)(?P<t>[a ]){_CLOCK}{_ZONE}")),
]
_EPOCH = re.compile(r"(?P<e>9{10}|9{13}|9{16})(?:\.(?P<f>9{1,9}))?")


def shape(c):
    """The mask of a text column, on the JVM side."""
    return F.translate(c, "0123456789" + _UP + _LOW, "9" * 10 + "a" * 52)


def compile_mask(mask: str) -> tuple[str, dict[str, tuple[int, int]]] | None:
    """A mask's parser: the kind of its date and the place of each field. Made once per distinct mask and process."""
    return _short_mask(mask) if len(mask) <= LONG else _fields_of(mask)


@lru_cache(maxsize=20_000)
def _short_mask(mask: str):
    return _fields_of(mask)


def _fields_of(mask: str):
    if m := _EPOCH.fullmatch(mask):
        return "epoch", {k: m.span(k) for k in ("e", "f") if m.group(k)}
    for kind, form in _FORMS:
        if m := form.fullmatch(mask):
            return kind, {k: m.span(k) for k, v in m.groupdict().items() if v is not None}
    return None


def tz_version() -> str:
    """The release of the tz database that the transition tables are made from; an error if it has no name."""
    try:
        import tzdata

        return tzdata.IANA_VERSION
    except ImportError:
        pass
    from zoneinfo import TZPATH

    for folder in TZPATH:
        try:
            with open(f"{folder}/tzdata.zi") as f:
                if m := re.match(r"# version (\S+)", f.readline()):
                    return m.group(1)
        except OSError:
            continue
    raise RuntimeError("no named release of the tz database: neither the package tzdata nor a tzdata.zi is there")


def _zone_bytes(name: str) -> bytes:
    """The compiled zone, from the package if it is there, else from the system's folders."""
    from zoneinfo import TZPATH

    try:
        from importlib import resources

        place = resources.files("tzdata.zoneinfo")
        for part in name.split("/"):
            place = place / part
        return place.read_bytes()
    except (ImportError, OSError):
        pass
    for folder in TZPATH:
        try:
            with open(f"{folder}/{name}", "rb") as f:
                return f.read()
        except OSError:
            continue
    raise KeyError(name)


CYCLE = 146_097 * 86_400  # seconds of 400 years, after which the calendar and all yearly rules repeat


@lru_cache(maxsize=700)
def zone_table(name: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Transitions (UTC seconds, the first from ever on) and the offsets from them on; None for an unknown name.

    They are those written in the compiled zone; where a yearly rule goes on after them, 400 years of it follow.
    """
    import io
    import struct
    from zoneinfo import ZoneInfo

    if not re.fullmatch(r"[A-Za-z0-9_+\-/]{1,64}", name) or name.startswith("/") or ".." in name:
        return None
    try:
        raw = _zone_bytes(name)
    except KeyError:
        return None
    if raw[:4] != b"TZif":
        return None

    def block(at: int, wide: int) -> tuple[np.ndarray, np.ndarray, int]:
        _, _, leaps, times, types, chars = counts = struct.unpack(">6l", raw[at + 20 : at + 44])
        at += 44
        moment = np.frombuffer(raw, f">i{wide}", times, at).astype("int64")
        kind = np.frombuffer(raw, "u1", times, at + times * wide)
        at += times * (wide + 1)
        offset = np.array([struct.unpack(">l", raw[at + 6 * i : at + 6 * i + 4])[0] for i in range(types)], "int64")
        return np.r_[np.iinfo("int64").min, moment], np.r_[offset[0], offset[kind]], at + 6 * types + chars + leaps * (wide + 4) + counts[0] + counts[1]

    at, offsets, end = block(0, 4)
    if raw[4:5] >= b"2":
        at, offsets, end = block(end, 8)
    if b"," in raw[end:]:  # the rule after the last transition
        zone = ZoneInfo.from_file(io.BytesIO(raw), key=name)
        base = datetime(1970, 1, 1, tzinfo=timezone.utc)
        off = lambda s: int((base + timedelta(seconds=int(s))).astimezone(zone).utcoffset().total_seconds())
        t = max(int(at[-1]), 0)
        o, more, step = off(t), [], 28 * 86400
        for n in range(t + step, t + CYCLE + step, step):
            if (x := off(n)) != o:
                low, high = n - step, n
                while high - low > 1:
                    mid = (low + high) // 2
                    low, high = (mid, high) if off(mid) == o else (low, mid)
                more.append((high, x))
                o = x
        at, offsets = np.r_[at, [m[0] for m in more]].astype("int64"), np.r_[offsets, [m[1] for m in more]].astype("int64")
    return at, offsets


def wall_to_utc(local: np.ndarray, name: str | None) -> tuple[np.ndarray, np.ndarray]:
    """UTC seconds of wall-clock seconds and whether there is exactly one."""
    table = zone_table(name) if name else None
    if table is None:
        return local, np.zeros(len(local), bool)
    at, offsets = table
    later = np.maximum(0, -((at[-1] - 366 * 86400 - local) // CYCLE)) if len(at) > 700 else np.zeros(len(local), "int64")  # beyond a rule's 400 years
    wall = local - later * CYCLE
    place = lambda u: np.searchsorted(at, u, "right") - 1
    first, last = place(wall - 93_600), place(wall + 93_600)
    utc, found = wall.copy(), np.zeros(len(wall), "int64")
    for j in range(int((last - first).max(initial=0)) + 1):
        own = np.minimum(first + j, last)
        u = wall - offsets[own]
        fits = (first + j <= last) & (place(u) == own)
        utc, found = np.where(fits, u, utc), found + fits
    return utc + later * CYCLE, found == 1


def offset_at(utc: np.ndarray, name: str) -> np.ndarray | None:
    """Offsets of a zone at UTC seconds, None for an unknown name."""
    table = zone_table(name)
    if table is None:
        return None
    at, offsets = table
    later = np.maximum(0, -((at[-1] - 366 * 86400 - utc) // CYCLE)) if len(at) > 700 else 0
    return offsets[np.searchsorted(at, utc - later * CYCLE, "right") - 1]


def _days(y: np.ndarray, m: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Days since 1970 of calendar dates and which of them exist."""
    ok = (y >= 1) & (y <= 9999) & (m >= 1) & (m <= 12) & (d >= 1) & (d <= 31)
    month = (np.where(ok, y, 1970) - 1970) * 12 + np.where(ok, m, 1) - 1
    day = month.astype("datetime64[M]").astype("datetime64[D]").astype("int64") + np.where(ok, d, 1) - 1
    return day, ok & (day.astype("datetime64[D]").astype("datetime64[M]").astype("int64") == month)


def _names(texts: pd.Series, known: dict) -> tuple[np.ndarray, np.ndarray]:
    codes, distinct = pd.factorize(texts)
    value = np.array([known.get(x.lower(), -(10**6)) for x in distinct], "int64")[codes]
    return value, value > -(10**6)


def parse_mask(mask: str, texts: list[str], zones: np.ndarray, orders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTC microseconds of texts that share a mask, and which of them name one instant."""
    n = len(texts)
    us, ok = np.zeros(n, "int64"), np.zeros(n, bool)
    if (parser := compile_mask(mask)) is None:
        return us, ok
    kind, at = parser
    letters = np.array(texts, dtype=f"U{len(mask)}").view("uint32").reshape(n, len(mask))
    digits = letters.astype("int64") - 48

    def num(k: str) -> np.ndarray:
        if k not in at:
            return np.zeros(n, "int64")
        a, b = at[k]
        return digits[:, a:b] @ (10 ** np.arange(b - a - 1, -1, -1, dtype="int64"))

    def word(k: str) -> pd.Series:
        a, b = at[k]
        return pd.Series([x[a:b] for x in texts])

    fraction = num("f") * 10 ** max(0, 6 - (at["f"][1] - at["f"][0])) // 10 ** max(0, at["f"][1] - at["f"][0] - 6) if "f" in at else np.zeros(n, "int64")
    if kind == "epoch":
        width = at["e"][1] - at["e"][0]
        if width != 10 and "f" in at:
            return us, ok
        return num("e") * 10 ** (16 - width) + fraction, np.ones(n, bool)
    ok = np.ones(n, bool)
    if kind == "num":
        a, b, c = num("A"), num("B"), num("C")
        if at["C"][1] - at["C"][0] == 2:
            y = np.select([orders == "ymd", (orders == "mdy") | (orders == "dmy")], [a, c], -1)
            d = np.where(orders == "ymd", c, np.where(orders == "mdy", b, a))
            m = np.where(orders == "mdy", a, b)
            ok &= (y >= 0) & ((orders != "ymd") | (at["A"][1] - at["A"][0] == 2))
            y = y + 2000
        else:
            ok &= (orders == "mdy") | (orders == "dmy")
            y, m, d = c, np.where(orders == "mdy", a, b), np.where(orders == "mdy", b, a)
    else:
        y, d, m = num("Y"), num("d"), num("m")
        if "b" in at:
            known = {x: i + 1 for i, x in enumerate(LONG_MONTHS)} | {x: i + 1 for i, x in enumerate(MONTHS)} | {"sept": 9}
            m, good = _names(word("b"), known)
            ok &= good
        if kind == "ymd" and mask[at["d"][1]] == "a":  # the letter between date and time
            between = letters[:, at["d"][1]]
            ok &= (between == ord("T")) | (between == ord("t"))
    if "t" in at and mask[at["t"][0]] == "a":
        ok &= np.isin(letters[:, at["t"][0]], (ord("T"), ord("t")))
    if kind in ("ordinal", "week"):
        day, good = _days(y, np.ones(n, "int64"), np.ones(n, "int64"))
        k = num("n")
        if kind == "ordinal":
            leap = (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))
            good &= (k >= 1) & (k <= 365 + leap)
            day = day + k - 1
        else:
            fourth = day + 3  # January 4 lies in week 1
            start = fourth - (fourth + 3) % 7
            day = start + (k - 1) * 7 + num("e") - 1
            thursday = (start + (k - 1) * 7 + 3).astype("datetime64[D]").astype("datetime64[Y]").astype("int64") + 1970
            good &= (k >= 1) & (num("e") >= 1) & (num("e") <= 7) & (thursday == y) & np.isin(letters[:, at["q"][0]], (ord("W"), ord("w")))
    else:
        day, good = _days(y, m, d)
    ok &= good
    if "w" in at:
        want, good = _names(word("w"), {x: i for i, x in enumerate(WEEKDAYS)} | {x: i for i, x in enumerate(LONG_WEEKDAYS)})
        ok &= good & (want == (day + 3) % 7)
    h, mi, s = num("H"), num("M"), num("S")
    if "p" in at:
        half, good = _names(word("p"), {"am": 0, "pm": 12, "a.m.": 0, "p.m.": 12})
        ok &= good & (h >= 1) & (h <= 12)
        h = h % 12 + half
    ok &= (h < 24) & (mi < 60) & (s < 60)
    local = day * 86400 + h * 3600 + mi * 60 + s
    if "z" in at or "u" in at:
        a, b = at["z"] if "z" in at else at["u"]
        if "u" in at:  # UTC or GMT, then the offset
            _, good = _names(pd.Series([x[a : a + 3] for x in texts]), {"utc": 0, "gmt": 0})
            ok &= good
            a = next(i for i in range(a, b) if mask[i] in "+-")
        part = mask[a + 1 : b].split(":")
        wide = len(part[0]) if len(part) > 1 or b - a <= 3 else b - a - 3
        hh = digits[:, a + 1 : a + 1 + wide] @ (10 ** np.arange(wide - 1, -1, -1, dtype="int64"))
        mm = digits[:, b - 2 : b] @ np.array([10, 1]) if b - a > 3 else np.zeros(n, "int64")
        ok &= (mm < 60) & (hh * 60 + mm <= 14 * 60)
        utc = local - (1 if mask[a] == "+" else -1) * (hh * 3600 + mm * 60)
        if "j" in at:
            codes, names = pd.factorize(word("j"))
            for i, name in enumerate(names):
                rows = codes == i
                known = offset_at(utc[rows], name)
                ok[rows] &= known == local[rows] - utc[rows] if known is not None else False
    elif "x" in at:
        minutes, good = _names(word("x"), ABBREVIATIONS)
        ok &= good
        utc = local - minutes * 60
    else:
        own = word("i" if "i" in at else "k") if "i" in at or "k" in at else zones
        utc = local.copy()
        codes, names = pd.factorize(own, use_na_sentinel=True)
        one = np.zeros(n, bool)
        for i, name in enumerate(names):
            rows = codes == i
            utc[rows], one[rows] = wall_to_utc(local[rows], name)
        ok &= one
    return utc * 1_000_000 + fraction, ok


def _convert(batches):
    for f in batches:
        us, ok = np.zeros(f.num_rows, "int64"), np.zeros(f.num_rows, bool)
        texts, zones, orders, shapes = (f[c].to_numpy(zero_copy_only=False) for c in ("_text", "_zone", "_order", "_mask"))
        codes, masks = pd.factorize(shapes)
        order = np.argsort(codes, kind="stable")
        ends = np.searchsorted(codes[order], np.arange(len(masks) + 1))
        for i, mask in enumerate(masks):
            rows = order[ends[i] : ends[i + 1]]
            us[rows], ok[rows] = parse_mask(mask, list(texts[rows]), zones[rows], orders[rows])
        yield pa.RecordBatch.from_arrays([f["_id"], pa.array(us, mask=~ok)], names=["_id", "utc_us"])


def normalise_timestamps(df: DataFrame, feeds: DataFrame, id_col: str = "raw_id", text: str = "measurement_tstamp", feed: str = "feed_id") -> DataFrame:
    """(id, utc_us): the instant each text names in UTC microseconds, null where it names none. One row per row of df.

    feeds: (feed_id, tz_name, date_order); of several rows of a feed the first by zone and order counts. Ids may repeat and
    may be null; extra columns are left out.
    """
    trimmed = F.btrim(F.col(text), F.lit(BLANKS))
    know = feeds.where("feed_id is not null").groupBy(F.col("feed_id").alias("_feed")).agg(F.min(F.struct(F.col("tz_name").alias("z"), F.lower("date_order").alias("o"))).alias("x"))
    know = know.select("_feed", F.col("x.z").alias("_zone"), F.col("x.o").alias("_order"))
    rows = df.select(F.col(id_col).alias("_id"), F.col(feed).alias("_f"), trimmed.alias("_text"))
    rows = rows.join(know, F.col("_f") == F.col("_feed"), "left")
    rows = rows.select("_id", F.coalesce("_text", F.lit("")).alias("_text"), F.coalesce(shape(F.col("_text")), F.lit("")).alias("_mask"), "_zone", "_order")
    return rows.mapInArrow(_convert, "_id bigint, utc_us bigint").withColumnRenamed("_id", id_col)


def parser_report(df: DataFrame, feeds: DataFrame, id_col: str = "raw_id", text: str = "measurement_tstamp", feed: str = "feed_id") -> DataFrame:
    """Per feed: texts, texts that name an instant, those delivered before that instant (a sign of a wrong zone), and the release of the zone tables."""
    got = normalise_timestamps(df, feeds, id_col, text, feed)
    base = df.select(F.col(id_col), F.col(feed).alias("feed_id"), micros("received_at").alias("_r"))
    return (
        base.join(got, id_col)
        .groupBy("feed_id")
        .agg(F.count("*").alias("n_texts"), F.count("utc_us").alias("n_instants"), F.count_if(F.col("_r") < F.col("utc_us")).alias("n_before_receipt"), F.lit(tz_version()).alias("tz_release"))
    )


def first_offset(name: str, utc_s: int) -> int | None:
    """Offset of a zone at an instant, from its transition table; for checks."""
    o = offset_at(np.array([utc_s]), name)
    return None if o is None else int(o[0])
