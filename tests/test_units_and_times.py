from datetime import datetime, timedelta, timezone

import pytest

from noticeworks.operators import timestamps as ts
from noticeworks.operators.units import fit_unit_mixture, harmonise_amounts, hidden_unit_accuracy, parse_amounts

AMOUNTS = [
    ("45.00万元", None, 45_000_000), ("412.45", "x。预算单位：万元。", 412_450_000), ("412", "金额以千元计", 41_200_000), ("237606元", "单位为万元", 23_760_600),
    ("412万元（大写：肆佰壹拾贰万元整）", None, 412_000_000), ("３３９３．３２万", None, 3_393_320_000), ("九十万元", None, 90_000_000), ("￥8万元", None, 8_000_000),
    ("698仟元", None, 69_800_000), ("119.37W", None, 119_370_000), ("6.44w元", None, 6_440_000), ("壹佰玖拾柒万肆仟捌佰壹拾肆元", None, 197_481_400),
    ("￥ 477,891.45 元", None, 47_789_145), ("人民币（元）：1,048,900.30", "单位为万元", 104_890_030), ("0.01亿元", None, 100_000_000), ("RMB 1.5m", None, 150_000_000),
    ("CNY 16.58 million", None, 1_658_000_000), ("0.2百万元", None, 20_000_000), ("壹亿零叁佰玖拾陆万圆整", None, 10_396_000_000), ("八千二百零一元五角", None, 820_150),
    ("1234", None, 123_400), (" ", None, None), (None, None, None), ("无", None, None), ("下浮率8%", None, None), ("15万元/年", None, None), ("每年29万元", None, None),
    ("35万美元", None, None), ("USD 59,000", None, None), ("22-107万元", None, None), ("/", None, None), ("折扣率", None, None), ("21元/㎡", None, None),
]


def test_amounts(spark):
    rows = [(i, b, s, "clash") for i, (b, s, _) in enumerate(AMOUNTS)] * 2
    df = spark.createDataFrame(rows, "id int, budget string, summary string, number_ string")
    got = {r["id"]: r["fen"] for r in harmonise_amounts(df, "budget", "summary").collect()}
    for i, (budget, _, fen) in enumerate(AMOUNTS):
        assert got[i] == fen, budget
    assert harmonise_amounts(df.where("false"), "budget", "summary").count() == 0
    assert parse_amounts(df, "budget", "summary").count() == len(rows)
    long = spark.createDataFrame([("前" * 100_000 + "5万元", "")], "budget string, summary string")
    assert harmonise_amounts(long, "budget", "summary").first()["fen"] == 5_000_000


def test_mixture_finds_units(spark):
    import random

    random.seed(1)
    true = [10 ** random.gauss(6, 0.25) for _ in range(600)]
    rows = [(i, f"{v:.2f}元" if i % 3 == 0 else f"{v:.2f}" if i % 3 == 1 else f"{v / 1e4:.4f}", "") for i, v in enumerate(true)]
    df = spark.createDataFrame(rows, "id int, budget string, summary string")
    out = harmonise_amounts(df, "budget", "summary", bare_rule=None).collect()
    good = sum(abs(r["fen"] / 100 - true[r["id"]]) < 0.01 * true[r["id"]] for r in out)
    assert good >= 590
    ruled = harmonise_amounts(df, "budget", "summary").where("id % 3 = 2")
    assert ruled.where("uncertain").count() >= 190 and ruled.where("unit = '元'").count() == 200


def test_hidden_units_are_found(spark):
    import random

    random.seed(2)
    rows = [(f"{10 ** random.gauss(6, 0.3) / f:.4f}{u}",) for _ in range(400) for u, f in (("元", 1), ("万元", 1e4))]
    df = spark.createDataFrame(rows, "budget string").selectExpr("budget", "'' as summary", "1 as unit_rank")
    out = {r["unit"]: r for r in hidden_unit_accuracy(df, "budget", "summary").collect()}
    assert all(out[u]["n"] > 50 and out[u]["right"] >= 0.98 * out[u]["n"] and out[u]["sure_right"] == out[u]["sure"] for u in ("元", "万元"))
    fixed = fit_unit_mixture(parse_amounts(df, "budget", "summary"), prior={"元": 1.0})
    assert fixed.unit_weights[0] == 1.0
    assert hidden_unit_accuracy(df.where("false"), "budget", "summary").count() == 0


def utc(text):
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp() * 1000)


TIMES = [
    ("2025-01-12T19:30:55", "Asia/Shanghai", "2025-01-12T11:30:55"), ("1775550601999", None, "2026-04-07T08:30:01.999"), ("1756596643", None, "2025-08-30T23:30:43"),
    ("20240322085122", "Asia/Shanghai", "2024-03-22T00:51:22"), ("20240503", "Asia/Shanghai", "2024-05-02T16:00:00"), ("46043", "Asia/Shanghai", "2026-01-20T16:00:00"),
    ("2025-09-08 24:00", "Asia/Shanghai", "2025-09-08T16:00:00"), ("2024年8月11日24时", None, "2024-08-11T16:00:00"), ("2026年3月26日下午5时42", None, "2026-03-26T09:42:00"),
    ("2025年4月26日中午12时15", None, "2025-04-26T04:15:00"), ("2024年3月10日凌晨2:30", "America/New_York", "2024-03-10T07:30:00"), ("2024-11-03 01:30", "America/New_York", "2024-11-03T05:30:00"),
    ("2025-12-31 11:30:01 +08:00", "Europe/Berlin", "2025-12-31T03:30:01"), ("2024-09-05 09:15:09 +0530", None, "2024-09-05T03:45:09"), ("2024-10-05 23:25(UTC+8)", "Europe/London", "2024-10-05T15:25:00"),
    ("2024-12-02 18:00（北京时间）", "Europe/London", "2024-12-02T10:00:00"), ("Sun, 05 May 2024 08:00:50 GMT", None, "2024-05-05T08:00:50"), ("30 Mar 2025 03:11 CEST", "Asia/Shanghai", "2025-03-30T01:11:00"),
    ("October 20, 2025 1:00 pm", "America/New_York", "2025-10-20T17:00:00"), ("'2025-10-09'", "Europe/Berlin", "2025-10-08T22:00:00"), ("２０２６-０５-１４ １７：１５", None, "2026-05-14T09:15:00"),
    ("2025-12-17T10:30:13.257000Z", None, "2025-12-17T10:30:13.257"), ("2024-07-19", "Asia/Kathmandu", "2024-07-18T18:15:00"),
]


@pytest.mark.parametrize("text,zone,expected", TIMES)
def test_readings(text, zone, expected):
    assert [ms for _, ms in ts.readings(ts.tidy(text), zone)] == [utc(expected)]


@pytest.mark.parametrize("text", ["", "/", "另行通知", "0000-00-00", "2025年", "2026年3月", "6月20日", "09-15", "14:30", "2025-02-30", "99999", "2025-13-01"])
def test_no_readings(text):
    assert ts.readings(ts.tidy(text), None) == []


def test_periods():
    ends = lambda s: ts.period_ends(ts.tidy(s))
    assert ends("2025.11.14-2025.11.24") == ("2025.11.14", "2025.11.24")
    assert ends("1757393160000-1757737800000") == ("1757393160000", "1757737800000")
    assert ends("2024年2月14日—2月26日") == ("2024年2月14日", "2024年2月26日")
    assert ends("2024年4月15日至2024年4月30日（每日上午9:00至12:00，下午14:00至17:00）") == ("2024年4月15日", "2024年4月30日")
    assert ends("2026年5月22日起") == ("2026年5月22日", None) and ends("2025-11-11 12:30止") == (None, "2025-11-11 12:30")
    assert ends("自2024年1月28日下午3:53起至2024年2月12日下午4:00止") == ("2024年1月28日下午3:53", "2024年2月12日下午4:00")


def test_viterbi_follows_habit_and_time():
    day = 86_400_000
    both = lambda a, b: [("mdy", a * day), ("dmy", b * day)]
    assert ts.viterbi([both(10, 40), both(11, 70)], "dmy", (None, None)) == [1, 1]
    assert ts.viterbi([both(100, 40), both(101, 42)], None, ("mdy", 99 * day)) == [0, 0]
    assert ts.viterbi([both(10, 100), both(11, 101)], None, (None, 99 * day)) == [1, 1]
    assert ts.viterbi([both(1, 1)], None, (None, None)) == [0]


def test_normalise_times(spark):
    t0 = datetime(2026, 1, 1)
    notices = spark.createDataFrame(
        [(1, "US", t0, "03/04/2026", None, "", "x"), (2, "DE", t0, "03/04/2026", "03.04.2026 10:00", None, "x"), (3, None, None, "2026-03-04", "", "2026-03-04至3月6日", "x"), (3, None, None, "2026-03-04", "", "/", "x"), (4, "??", t0, None, None, None, "x")],
        "notice_id long, source_name string, first_seen_at timestamp, published_at string, bid_deadline string, registration_period string, zone string",
    ).drop("zone")
    sources = spark.createDataFrame([("US", "America/New_York", "mdy", "h"), ("DE", "Europe/Berlin", "dmy", "h")], "source_name string, zone string, date_order string, host string")
    got = sorted((r["notice_id"], r["field"], r["utc_ms"]) for r in ts.normalise_times(notices, sources).collect())
    assert (1, "published_at", utc("2026-03-04T05:00:00")) in got and (2, "published_at", utc("2026-04-02T22:00:00")) in got
    assert (2, "bid_deadline", utc("2026-04-03T08:00:00")) in got
    assert sum(1 for g in got if g[0] == 3 and g[1] == "published_at") == 2
    assert ts.normalise_times(notices.where("false"), sources).count() == 0


def test_hot_source_is_split(spark):
    rows = spark.range(3000).selectExpr("id as notice_id", "'S' as source_name", "timestamp'2025-01-01 00:00:00' + make_dt_interval(cast(id % 400 as int)) as first_seen_at", "'2025-05-0' || (1 + id % 9) as published_at", "'' as bid_deadline", "'' as registration_period")
    sources = spark.createDataFrame([("S", "UTC", "ymd")], "source_name string, zone string, date_order string")
    assert ts.normalise_times(rows, sources).count() == 3000


def _chosen(spark, values, sources=(), starts=None, kept=ts.OPEN_RECORDS, **conf):
    start = datetime(2025, 4, 6)
    rows = [(i, v[0], start + timedelta(hours=12 * i) if starts is None else starts[i], v[1], "", "") for i, v in enumerate(values)]
    notices = spark.createDataFrame(rows, "notice_id long, source_name string, first_seen_at timestamp, published_at string, bid_deadline string, registration_period string")
    known = spark.createDataFrame(list(sources), "source_name string, zone string, date_order string")
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return {r["notice_id"]: r["reading"] for r in ts.normalise_times(notices, known, kept).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_later_evidence_counts(spark):
    got = _chosen(spark, [("S", v) for v in ("03/04/2025", "04/04/2025", "05/04/2025", "25/04/2025")])
    assert [got[i] for i in range(4)] == ["dmy"] * 4


def test_no_border_between_weeks(spark):
    monday = datetime(2025, 4, 7)
    starts = [monday - timedelta(days=1), monday, monday + timedelta(days=2)]
    got = _chosen(spark, [("S", v) for v in ("25/03/2025", "03/04/2025", "05/04/2025")], starts=starts)
    assert [got[i] for i in range(3)] == ["dmy"] * 3


@pytest.mark.parametrize("size", ["1", "10000"])
def test_no_border_between_batches(spark, size):
    got = _chosen(spark, [("S", v) for v in ("12/04/2025", "01/05/2025")], **{"spark.sql.execution.arrow.maxRecordsPerBatch": size})
    assert [got[0], got[1]] == ["mdy", "mdy"] or [got[0], got[1]] == ["dmy", "dmy"]
    assert got == _chosen(spark, [("S", v) for v in ("12/04/2025", "01/05/2025")])


@pytest.mark.parametrize("parts,kept", [("1", 50_000), ("7", 50_000), ("7", 3), ("40", 2)])
def test_pass_is_whole_however_it_is_cut(spark, parts, kept):
    """The readings are those of one pass over each source, for any number of partitions and any length of stretches."""
    import random

    rng = random.Random(3)
    kinds = ["{m:02d}/{d:02d}/2025", "{d:02d}/{m:02d}/2025", "2025-{m:02d}-{d:02d}", "{d}.{m}.2025"]
    values = []
    for i in range(160):
        source = rng.choice(["A", "A", "A", "B", None])
        day = datetime(2025, 1, 1) + timedelta(days=i // 3 + rng.randint(-1, 1))
        values.append((source, rng.choices(kinds, [5, 2, 2, 1])[0].format(m=day.month, d=min(day.day, 12) if rng.random() < 0.9 else day.day)))
    sources = [("A", "UTC", "ymd"), ("B", "UTC", "dmy")]
    expected = {}
    for name, order in (("A", "ymd"), ("B", "dmy"), (None, None)):
        mine = [(i, ts.readings(ts.tidy(v), "UTC" if name else None)) for i, (s, v) in enumerate(values) if s == name]
        mine = [(i, c) for i, c in mine if c]
        for (i, c), k in zip(mine, ts.best_path([(None, None, 0)], mine, order)):
            expected[i] = c[k][0]
    got = _chosen(spark, values, sources, kept=kept, **{"spark.sql.shuffle.partitions": parts})
    assert got == expected
    assert {"mdy", "dmy"} <= set(got.values())
