"""Mixed timestamp formats and zones brought to UTC instants (problem 4).

Every valid reading of a value is generated as an array of (reading, instant); a Viterbi pass over each source's record
order then chooses one per value, penalising readings that differ from the source's declared order, switches of reading,
and jumps back in time. What comes later counts as well as what came before, however the records are spread over tasks.

Defined results: null, empty and placeholder texts and values without a full date have no reading and give no row; an
empty table gives an empty result; repeated rows are kept; of equally good passes that with fewer later readings in the
arrays holds, then a hash of notice_id decides; records of one time are in order of notice_id; only
named columns are read, so extra columns never clash; texts of any length are searched whole.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from datetime import datetime, timedelta
from functools import lru_cache
from zoneinfo import ZoneInfo

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import partitions, written

DEFAULT_ZONE = "Asia/Shanghai"
#: Years a notice may speak of; readings outside are not generated.
FIRST_YEAR, LAST_YEAR = 1990, 2100

# Abbreviations of zones as hours from UTC.
ZONE_HOURS = {
    "gmt": 0, "utc": 0, "z": 0, "bst": 1, "wet": 0, "west": 1, "cet": 1, "cest": 2, "eet": 2, "eest": 3, "msk": 3,
    "est": -5, "edt": -4, "cst": -6, "cdt": -5, "mst": -7, "mdt": -6, "pst": -8, "pdt": -7,
    "aest": 10, "aedt": 11, "acst": 9.5, "acdt": 10.5, "awst": 8, "nzst": 12, "nzdt": 13, "jst": 9, "hkt": 8, "sgt": 8, "npt": 5.75,
}
# The names of the months.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

_CN_ZONES = ("北京时间", "中国标准时间")
_ABBR = "|".join(sorted((k for k in ZONE_HOURS if k != "z"), key=len, reverse=True))
_MONTH = "(" + "|".join(MONTHS) + ")[a-z]*\\.?"
_HALF = "上午|下午|晚上|中午|凌晨|早上|傍晚|夜间"


_SPACES = re.compile(r"\s+")
_QUOTES = re.compile("^[ '\"“”‘’`]+|[ '\"“”‘’`]+$")
_AROUND = re.compile(" ?([年月日时分秒点]) ?")
_WIDE = {code: code - 0xFEE0 for code in range(0xFF01, 0xFF5F)} | {0x3000: 0x20}
_YMD = re.compile(r"(?:[a-z]{3,9},? )?(\d{4})[-/.年](\d{1,2})[-/.月](\d{1,2})日?")
_NUM = re.compile(r"(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})")
_DMON = re.compile(rf"(?:[a-z]{{3,9}},? )?(\d{{1,2}})(?:st|nd|rd|th)?[ -]{_MONTH}[ ,-]+(\d{{4}})")
_MOND = re.compile(rf"(?:[a-z]{{3,9}},? )?{_MONTH} (\d{{1,2}})(?:st|nd|rd|th)?,? (\d{{4}})")
_CLOCK = re.compile(r"(\d{1,2})(?:[:时点](\d{1,2})?)(?:[:分](\d{1,2})?)?(?:秒)?(?:[.,](\d{1,9}))?")
_HALF_DAY = re.compile(rf"({_HALF}|(?<=\d) ?[ap]\.?m\b)")
_OFFSET = re.compile(r"\d ?(?:\(?(?:utc|gmt))?([+-])(\d{1,2}):?(\d{2})?\)?$")
_ZONE = re.compile(rf"\b({_ABBR})\)?$")
_DIGITS = re.compile(r"(\d{5,14})(\.\d+)?")
_EPOCH = datetime(1970, 1, 1)


def tidy(text: str) -> str:
    """Width folded, lower case, quotes and outer spaces gone, no spaces around date characters."""
    t = _SPACES.sub(" ", text.translate(_WIDE).lower())
    return _AROUND.sub(r"\1", _QUOTES.sub("", t)).strip()


def _utc_ms(wall: datetime, zone: ZoneInfo) -> int:
    """Of a clock time that occurs twice the first; one that was skipped is later by the length of the gap."""
    return int((wall - _EPOCH).total_seconds() * 1000 + 0.5) - int(wall.replace(tzinfo=zone, fold=0).utcoffset().total_seconds() * 1000)


def _wall(y: int, m: int, d: int, h: int = 0, mi: int = 0, s: int = 0) -> datetime | None:
    """A wall time if there is such a day and time; 24:00 is 0:00 of the next day."""
    if not FIRST_YEAR <= y <= LAST_YEAR:
        return None
    try:
        if h == 24 and mi == 0 and s == 0:
            return datetime(y, m, d) + timedelta(days=1)
        return datetime(y, m, d, h, mi, s)
    except ValueError:
        return None


@lru_cache(maxsize=1000)
def _zone(name: str | None) -> ZoneInfo:
    try:
        return ZoneInfo(name or DEFAULT_ZONE)
    except (KeyError, ValueError, OSError):
        return ZoneInfo(DEFAULT_ZONE)


def readings(t: str, zone_name: str | None) -> list[tuple[str, int]]:
    """All valid readings of a tidied point of time as (reading, UTC milliseconds), in fixed order; [] if none.

    A zone or offset in the text counts, else ``zone_name``.
    """
    zone = _zone("Asia/Shanghai" if any(name in t for name in _CN_ZONES) else zone_name)
    whole = _DIGITS.fullmatch(t)
    if whole:
        found, n, digits = [], len(whole[1]), whole[1]
        low, high = (FIRST_YEAR - 1970) * 31_556_952, (LAST_YEAR - 1970) * 31_556_952
        if n in (12, 13) and not whole[2] and low * 1000 <= int(digits) <= high * 1000:
            found.append(("milliseconds", int(digits)))
        if n in (9, 10) and low <= int(digits) <= high:
            found.append(("seconds", int(digits) * 1000 + int(float(whole[2] or 0) * 1000 + 0.5)))
        if n in (8, 12, 14) and not whole[2]:
            wall = _wall(int(digits[:4]), int(digits[4:6]), int(digits[6:8]), int(digits[8:10] or 0), int(digits[10:12] or 0), int(digits[12:14] or 0))
            if wall:
                found.append(("compact", _utc_ms(wall, zone)))
        if n == 5 and 32_874 <= int(digits) <= 73_050:
            found.append(("day count", _utc_ms(datetime(1899, 12, 30) + timedelta(seconds=round(float(t) * 86400)), zone)))
        return found
    for form, pattern in (("ymd", _YMD), ("num", _NUM), ("dmon", _DMON), ("mond", _MOND)):
        m = pattern.match(t)
        if m:
            break
    else:
        return []
    rest = t[m.end() :]
    clock, half = _CLOCK.search(rest), _HALF_DAY.search(rest)
    h, mi, s, ms = 0, 0, 0, 0
    if clock:
        h, mi, s = int(clock[1]), int(clock[2] or 0), int(clock[3] or 0)
        ms = int((clock[4] or "0").ljust(3, "0")[:3])
        if half and half[1].strip()[0] in "下晚傍夜p" and h < 12:
            h += 12
        elif half and half[1].strip()[0] in "上凌早a" and h == 12:
            h = 0
        elif half and half[1] == "中午" and h < 11:
            h += 12
    offset = None
    signed, named = _OFFSET.search(rest) if clock else None, _ZONE.search(rest)
    if signed:
        offset = (-1 if signed[1] == "-" else 1) * (int(signed[2]) * 60 + int(signed[3] or 0))
    elif rest.endswith("z") and rest[-2:-1].isdigit():
        offset = 0
    elif named:
        offset = int(ZONE_HOURS[named[1]] * 60)
    g = m.groups()
    dates = {
        "ymd": [("ymd", g)], "num": [("mdy", (g[2], g[0], g[1])), ("dmy", (g[2], g[1], g[0]))] if form == "num" else [],
        "dmon": [("d mon y", (g[2], g[1], g[0]))], "mond": [("mon d y", (g[2], g[0], g[1]))],
    }[form]
    found = []
    for reading, (y, month, d) in dates:
        wall = _wall(int(y), MONTHS.index(month) + 1 if month in MONTHS else int(month), int(d), h, mi, s)
        if wall:
            utc = _utc_ms(wall, zone) if offset is None else int((wall - _EPOCH).total_seconds()) * 1000 - offset * 60_000
            found.append((reading, utc + ms))
    return found


_DAILY = re.compile(r"[(（][^()（）]*(?:每日|每天|daily|工作日)[^()（）]*[)）]")
_FROM = re.compile(r"^(?:自|从|由|from )")
_BOTH = [
    re.compile(p)
    for p in (
        r"(.*\d.*?)起(?:至|到|-|~)(.*\d.*?)(?:止|为止)?",
        r"(\S+t\S+)/(\S+t\S+)",
        r"(.*?\d.*?) ?(?:至|到|~|—+|–|－) ?(.*?\d.*?)(?:止)?",
        r"(.*?\d.*?) (?:-|to|until) (.*?\d.*?)",
        r"(\d{4}[./]\d{1,2}[./]\d{1,2})-(\d{4}[./]\d{1,2}[./]\d{1,2})",
        r"(\d{5,14})-(\d{5,14})",
        r"(\d{4}年.*)-((?:\d{4}年)?\d{1,2}月.*)",
    )
]
_ONLY_END = re.compile(r"(?:截止|截至|至|until )?(.*\d.*?)(?:止|前|为止)")
_ONLY_START = re.compile(r"(.*\d.*?)起")
_YEARLESS = re.compile(r"\d{1,2}(?:月|[-/.]\d{1,2}(?:$|[ t日]))")


def period_ends(t: str) -> tuple[str | None, str | None]:
    """Start and end of a tidied period, None where open. Daily office hours do not count; an end without a year takes the start's."""
    t = _FROM.sub("", _DAILY.sub("", t).strip()).strip()
    for pattern in _BOTH:
        m = pattern.fullmatch(t)
        if m:
            start, end = m[1].strip(), m[2].strip()
            year = re.match(r"(\d{4})[-/.年]", start)
            if year and _YEARLESS.match(end):
                end = year[1] + ("年" if re.match(r"\d{1,2}月", end) else "-") + end
            return start, end
    if m := _ONLY_START.fullmatch(t):
        return m[1].strip(), None
    if m := _ONLY_END.fullmatch(t):
        return None, m[1].strip()
    return t, None


#: Costs of the Viterbi pass: a reading against the source's declared order, a switch of reading, a jump back in time.
AGAINST_ORDER, SWITCH, BACKWARD = 50, 2, 1
#: Records may be out of order by this much without cost.
SLACK_MS = 86_400_000
#: Records that a task keeps at most before it cuts a stretch of undecided ones; only memory depends on it.
OPEN_RECORDS = 50_000

_ORDERS = ("mdy", "dmy")
#: Costs are whole numbers above this bit; below it, readings that come later in the array cost more, and then a hash decides.
_WHOLE = 96

Candidates = list[tuple[str, int]]
#: What is known after a record: the last reading of bare numbers, the instant, and the cost so far.
Alive = tuple[str | None, int | None, int]


def _own(cands: Candidates, k: int, order: str | None, salt: int) -> int:
    against = order in _ORDERS and cands[k][0] in _ORDERS and cands[k][0] != order
    return (AGAINST_ORDER << _WHOLE if against else 0) + (k << 64) + (k * salt * 0x9E3779B1 & 0xFFFFFFFF)


def _between(habit: str | None, then: int | None, reading: str, ms: int) -> int:
    cost = SWITCH if habit in _ORDERS and reading in _ORDERS and habit != reading else 0
    return (cost + (BACKWARD if then is not None and ms < then - SLACK_MS else 0)) << _WHOLE


def advance(alive: list[Alive], cands: Candidates, order: str | None, salt: int) -> tuple[list[Alive], list[tuple[int, int]]]:
    """The states after one more record, and of each the candidate it takes and the state it comes from."""
    best: dict[tuple[str | None, int], tuple[int, int]] = {}
    for k, (reading, ms) in enumerate(cands):
        own = _own(cands, k, order, salt)
        for at, (habit, then, cost) in enumerate(alive):
            key = (reading if reading in _ORDERS else habit, k)
            c = cost + own + _between(habit, then, reading, ms)
            if key not in best or c < best[key][0]:
                best[key] = (c, at)
    return [(habit, cands[k][1], c) for (habit, k), (c, _) in best.items()], [(k, at) for (_, k), (_, at) in best.items()]


def best_path(alive: list[Alive], records: list[tuple[int, Candidates]], order: str | None, end: tuple[str | None, int] | None = None) -> list[int]:
    """Index of the chosen reading of each record (salt, candidates) after the states ``alive``; ``end``: the habit and instant to end in."""
    links = []
    for salt, cands in records:
        alive, back = advance(alive, cands, order, salt)
        links.append(back)
    if not links:
        return []
    ends = [i for i, (habit, ms, _) in enumerate(alive) if end is None or (habit, ms) == end]
    at = min(ends, key=lambda i: alive[i][2])
    path = []
    for back in reversed(links):
        k, at = back[at]
        path.append(k)
    return path[::-1]


def viterbi(cands: list[Candidates], order: str | None, before: tuple[str | None, int | None]) -> list[int]:
    """Index of the chosen reading per record. ``before``: habit and instant of the record before these."""
    return best_path([(*before, 0)], list(enumerate(cands)), order)


def crossings(records: list[tuple[int, Candidates]], order: str | None) -> list[tuple[str | None, int, list[Alive]]]:
    """Of a stretch whose past is unknown: for each habit before it and candidate of its first record, the states at its end."""
    salt, first = records[0]
    out = []
    for k, (reading, ms) in enumerate(first):
        for habit in (None,) if reading in _ORDERS else (None, *_ORDERS):
            alive = [(reading if reading in _ORDERS else habit, ms, _own(first, k, order, salt))]
            for later_salt, cands in records[1:]:
                alive, _ = advance(alive, cands, order, later_salt)
            out.append((habit, k, alive))
    return out


class Chain:
    """The records of one source and field in order, as far as one task sees them.

    Candidates are decided as soon as a record of one bare-number reading (or the chain's end) settles what came before it.
    What stays open where the task's part begins or ends, or where a stretch grows too long, becomes a segment of its own:
    ``segments`` get its records and what the pass over all segments needs (entry or crossings).
    """

    def __init__(self, order: str | None, known: bool):
        self.order = order
        self.entry: tuple[str | None, int | None] | None = (None, None) if known else None
        self.records: list[tuple[int, Candidates]] = []

    @staticmethod
    def _plain(cands: Candidates) -> bool:
        return len(cands) == 1 and cands[0][0] not in _ORDERS

    def add(self, notice: int, cands: Candidates) -> list[tuple[int, str, int]] | None:
        """Takes a record; gives (notice, reading, instant) of what is decided by it. None: cut here, the stretch is too long."""
        decided = [(notice, *cands[0])] if len(cands) == 1 else []
        if self.entry is not None and not self.records and len(cands) == 1:
            self.entry = (cands[0][0] if cands[0][0] in _ORDERS else self.entry[0], cands[0][1])
            return decided
        if len(self.records) > 1 and self._plain(cands) and self._plain(self.records[-1][1]) and self._plain(self.records[-2][1]):
            self.records[-1] = (notice, cands)  # what lies between such records costs the same on all paths
        else:
            self.records.append((notice, cands))
        if self.entry is not None and len(cands) == 1 and cands[0][0] in _ORDERS:
            decided += self.settle()
            self.entry, self.records = cands[0], []
        return decided

    def settled_by(self, cands: Candidates) -> bool:
        return self.entry is None and len(cands) == 1 and cands[0][0] in _ORDERS

    def settle(self) -> list[tuple[int, str, int]]:
        """Decides all open records; those of one reading were given before."""
        path = best_path([(*self.entry, 0)], self.records, self.order)
        return [(notice, *cands[k]) for (notice, cands), k in zip(self.records, path) if len(cands) > 1]

    def segment(self) -> dict:
        """The open stretch as plain data, and the chain goes on after it with its past unknown."""
        data = {"order": self.order, "entry": self.entry, "first": self.records[0][1] if self.records else [], "open": any(len(c) > 1 for _, c in self.records)}
        if self.entry is None:
            data["crossings"] = crossings(self.records, self.order) if self.records else None
        else:
            alive: list[Alive] = [(*self.entry, 0)]
            for salt, cands in self.records:
                alive, _ = advance(alive, cands, self.order, salt)
            data["alive"] = alive
        return data


def _segment_ends(segments: list[dict]) -> list[tuple[list[Alive], tuple[str | None, int] | None]]:
    """For each segment of one chain, in order: the states it is entered with, and the (habit, instant) it ends in."""
    alive: list[Alive] = [(None, None, 0)]
    entered: list[list[Alive]] = []
    links: list[list[int | None]] = []
    states: list[list[Alive]] = []
    for s in segments:
        entered.append(alive)
        if s["entry"] is not None:  # all before it ended in one state
            alive = [tuple(x) for x in s["alive"]]
            links.append([0] * len(alive))
        elif s["crossings"] is not None:
            best: dict[tuple[str | None, int], tuple[int, int]] = {}
            for habit, k, ends in s["crossings"]:
                reading, ms = s["first"][k]
                for at, (before, then, cost) in enumerate(alive):
                    if reading not in _ORDERS and before != habit:
                        continue
                    for end_habit, end_ms, c in ends:
                        total = cost + _between(before, then, reading, ms) + c
                        if (end_habit, end_ms) not in best or total < best[end_habit, end_ms][0]:
                            best[end_habit, end_ms] = (total, at)
            alive = [(h, m, c) for (h, m), (c, _) in best.items()]
            links.append([at for _, at in best.values()])
        else:
            links.append(list(range(len(alive))))
        states.append(alive)
    ends: list[tuple[str | None, int] | None] = [None] * len(segments)
    at = min(range(len(alive)), key=lambda i: alive[i][2])
    for i in reversed(range(len(segments))):
        ends[i] = states[i][at][:2]
        if segments[i]["entry"] is None:
            at = links[i][at]
        elif i:  # the segment before it was ended by what this one is entered with
            known = [j for j, a in enumerate(states[i - 1]) if a[:2] == tuple(segments[i]["entry"])]
            at = known[0] if known else min(range(len(states[i - 1])), key=lambda j: states[i - 1][j][2])
    return [([(*s["entry"], 0)] if s["entry"] is not None else e, end) for s, e, end in zip(segments, entered, ends)]


_FIELDS = ("published_at", "bid_deadline", "registration_start", "registration_end")
_POINTS = "notice_id bigint, field string, source_name string, reading string, utc_ms bigint"


def _read_and_choose(batches: Iterator[pa.RecordBatch], open_records: int) -> Iterator[pa.RecordBatch]:
    """Notices sorted by source and record order: reads their texts and decides what can be decided inside this partition."""
    part = TaskContext.get().partitionId()
    out: list[tuple] = []
    chains: dict[str, Chain] = {}
    source, first, seq = None, True, 0

    def cut(field: str, closed: bool = False) -> None:
        nonlocal seq
        chain = chains[field]
        data = chain.segment()
        records = [(notice, cands) for notice, cands in chain.records] if data["open"] else []
        out.append((None, field, source, None, None, part, seq, json.dumps(data), json.dumps(records)))
        seq += 1
        chains[field] = Chain(chain.order, False)

    def end() -> None:
        """The source has no more records."""
        for field, chain in chains.items():
            if chain.entry is None and chain.records:
                cut(field)
            elif chain.records:
                out.extend((notice, field, source, reading, ms, None, None, None, None) for notice, reading, ms in chain.settle())

    def table() -> pa.RecordBatch:
        cols = list(zip(*out)) or [()] * 9
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string()]
        rows = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["notice_id", "field", "source_name", "reading", "utc_ms", "part", "seq", "segment", "records"])
        out.clear()
        return rows

    for batch in batches:
        known: dict[tuple[str, str | None], Candidates] = {}
        notices, sources, orders, zones, published, deadlines, periods = (batch.column(i).to_pylist() for i in range(7))
        for i in range(batch.num_rows):
            if not chains or sources[i] != source:
                if chains:
                    end()
                    first = False
                source = sources[i]
                chains = {field: Chain(orders[i], not first) for field in _FIELDS}
            ends = period_ends(tidy(periods[i])) if periods[i] else (None, None)
            for field, text in zip(_FIELDS, (published[i] and tidy(published[i]), deadlines[i] and tidy(deadlines[i]), *ends)):
                if not text:
                    continue
                cands = known.get((text, zones[i]))
                if cands is None:
                    cands = known[text, zones[i]] = readings(text, zones[i])
                if not cands:
                    continue
                chain = chains[field]
                if chain.settled_by(cands):
                    chain.add(notices[i], cands)
                    out.append((notices[i], field, source, *cands[0], None, None, None, None))
                    cut(field)
                    chains[field].entry = cands[0]
                    continue
                out.extend((notice, field, source, reading, ms, None, None, None, None) for notice, reading, ms in chain.add(notices[i], cands))
                if len(chain.records) >= open_records:
                    cut(field)
        yield table()
    for field, chain in chains.items():  # the source may go on in the next partition
        if chain.records or chain.entry is not None:
            cut(field)
    yield table()


def normalise_times(notices: DataFrame, sources: DataFrame, open_records: int = OPEN_RECORDS) -> DataFrame:
    """One row per stated point of time: ``notice_id, field, source_name, reading, utc_ms``.

    ``notices`` needs notice_id, source_name, first_seen_at and the three text fields; ``sources`` source_name, zone and
    date_order. A notice whose source is null or unknown has the zone ``DEFAULT_ZONE`` and no declared order.

    Notices are range-partitioned by source and record order, so that a source of any size is spread over tasks; each task
    runs the Viterbi pass over its part. Where a part begins or ends among undecided values, the pass over the whole source
    is put together from the costs of crossing each such stretch (a few numbers per partition and field, the only
    thing that comes to the driver), and the stretches are then decided. The result is that of one pass per source.
    """
    spark = notices.sparkSession
    habits = sources.select(F.col("source_name").alias("_source"), "zone", "date_order")
    rows = notices.join(habits, F.col("source_name") == F.col("_source"), "left")
    texts = ["published_at", "bid_deadline", "registration_period"]
    narrow = rows.select(F.col("notice_id").cast("bigint").alias("notice_id"), "source_name", "date_order", "zone", *texts, "first_seen_at")
    ranged = narrow.repartitionByRange(partitions(spark), "source_name", "first_seen_at", "notice_id").sortWithinPartitions("source_name", "first_seen_at", "notice_id", F.xxhash64(*texts))
    read = written(ranged.mapInArrow(lambda batches: _read_and_choose(batches, open_records), f"{_POINTS}, part int, seq int, segment string, records string"), "points")
    decided = read.where("segment is null").select("notice_id", "field", "source_name", "reading", "utc_ms")

    by_chain: dict[tuple, list[tuple]] = {}
    for r in read.where("segment is not null").select("source_name", "field", "part", "seq", "segment").collect():
        by_chain.setdefault((r["source_name"], r["field"]), []).append((r["part"], r["seq"], json.loads(r["segment"])))
    plan: dict[tuple[int, int], tuple] = {}
    for chain in by_chain.values():
        chain.sort(key=lambda x: x[:2])
        for (part, seq, s), ends in zip(chain, _segment_ends([s for _, _, s in chain])):
            if s["open"]:
                plan[part, seq] = (s["order"], *ends)
    if not plan:
        return decided

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for field, source, part, seq, records in zip(*(c.to_pylist() for c in batch.columns)):
                order, alive, end = plan[part, seq]
                records = [(notice, [tuple(c) for c in cands]) for notice, cands in json.loads(records)]
                for (notice, cands), k in zip(records, best_path(alive, records, order, end)):
                    if len(cands) > 1:
                        out.append((notice, field, source, *cands[k]))
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()])], names=["notice_id", "field", "source_name", "reading", "utc_ms"])

    left_open = read.where("segment is not null and records != '[]'").select("field", "source_name", "part", "seq", "records")
    return decided.unionByName(left_open.mapInArrow(decide, _POINTS))
