import pytest
from pyspark.sql import functions as F

from millrace.functions import host_domain
from millrace.operators import (
    count_by_suffix,
    filter_suffix,
    log_time_parts,
    parse_access_log,
    top_domain_activity,
    top_domains,
    with_region,
)
from tests.helpers import rows

# Lines of a public access log and their fields.
GOLDEN = [
    ('199.72.81.55 - - [01/Jul/1995:00:00:01 -0400] "GET /history/apollo/ HTTP/1.0" 200 6245',
     ("199.72.81.55", "01/Jul/1995:00:00:01 -0400", "GET /history/apollo/ HTTP/1.0", 200, 6245)),
    ('unicomp6.unicomp.net - - [01/Jul/1995:00:00:06 -0400] "GET /shuttle/countdown/ HTTP/1.0" 200 3985',
     ("unicomp6.unicomp.net", "01/Jul/1995:00:00:06 -0400", "GET /shuttle/countdown/ HTTP/1.0", 200, 3985)),
    ('burger.letters.com - - [01/Jul/1995:00:00:11 -0400] "GET /shuttle/countdown/liftoff.html HTTP/1.0" 304 0',
     ("burger.letters.com", "01/Jul/1995:00:00:11 -0400", "GET /shuttle/countdown/liftoff.html HTTP/1.0", 304, 0)),
    ('129.94.144.152 - - [01/Jul/1995:00:00:13 -0400] "GET / HTTP/1.0" 200 7074',
     ("129.94.144.152", "01/Jul/1995:00:00:13 -0400", "GET / HTTP/1.0", 200, 7074)),
    ('ppptky391.asahi-net.or.jp - - [01/Jul/1995:00:00:18 -0400] "GET /facts/about_ksc.html HTTP/1.0" 200 3977',
     ("ppptky391.asahi-net.or.jp", "01/Jul/1995:00:00:18 -0400", "GET /facts/about_ksc.html HTTP/1.0", 200, 3977)),
    ('net-1-141.eden.com - - [01/Jul/1995:00:00:19 -0400] "GET /shuttle/missions/sts-71/images/KSC-95EC-0916.jpg HTTP/1.0" 200 34029',
     ("net-1-141.eden.com", "01/Jul/1995:00:00:19 -0400", "GET /shuttle/missions/sts-71/images/KSC-95EC-0916.jpg HTTP/1.0", 200, 34029)),
]


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value STRING")


def test_golden_lines(spark):
    parsed = parse_access_log(lines(spark, *[line for line, _ in GOLDEN]))
    assert rows(parsed.drop("ts")) == sorted([fields for _, fields in GOLDEN], key=repr)


def test_golden_time_parts(spark):
    timed = log_time_parts(parse_access_log(lines(spark, GOLDEN[0][0])))
    assert rows(timed, "hour", "day", F.col("ts").cast("string")) == [
        ("00", "01", "1995-07-01 00:00:01")
    ]


@pytest.mark.parametrize(
    "line, fields",
    [
        ('a.b - - [x] "GET /" 200 -', ("a.b", "x", "GET /", 200, None)),
        ('h - - [t] "GET "a" x" 200 5', ("h", "t", " x", 200, 5)),
        ('no separator "GET /" 404 9', ("", "", "GET /", 404, 9)),
        ("", ("", "", "", None, None)),
        ("host.only", ("", "", "", None, None)),
        ("h - - [01/Foo/1995:00:00:01 -0400] x 99999999999 1", ("h", "01/Foo/1995:00:00:01 -0400", "", None, 1)),
    ],
)
def test_malformed_lines_keep_their_row(spark, line, fields):
    parsed = parse_access_log(lines(spark, line))
    assert rows(parsed.drop("ts")) == [fields]
    assert rows(log_time_parts(parsed), "ts")[0][0] is None


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo"])
def test_wall_clock_ignores_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:  # 02:30 on this day does not exist in New York
        parsed = parse_access_log(lines(spark, 'h - - [02/Apr/1995:02:30:00 -0400] "G" 200 1'))
        assert rows(parsed, F.col("ts").cast("string")) == [("1995-04-02 02:30:00",)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    "host, n, domain",
    [
        ("x.tohoku.ac.jp", 3, "tohoku.ac.jp"),
        ("a.edu", 3, "a.edu"),
        ("www.mit.edu", 2, "mit.edu"),
        ("10.0.0.1", 2, "0.1"),
        ("", 3, ""),
        ("a.b.", 2, "b."),
    ],
)
def test_host_domain(spark, host, n, domain):
    assert spark.range(1).select(host_domain(F.lit(host), n)).first()[0] == domain


def hosts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "host STRING")


def test_suffix_filter_is_case_sensitive(spark):
    df = hosts(spark, "a.edu", "b.EDU", "edu", None)
    assert rows(filter_suffix(df, "host", ".edu")) == [("a.edu",)]
    counts = count_by_suffix(df, "host", {"U.S.": ".edu", "none": ".zz"})
    assert rows(counts) == [("U.S.", 1), ("none", 0)]


def test_overlapping_regions_count_twice(spark):
    regions = {"all": (".edu", 2), "mit": (".mit.edu", 3)}
    df = with_region(hosts(spark, "x.mit.edu", "y.cmu.edu", "z.com"), regions)
    assert rows(df, "region", "domain") == [
        ("all", "cmu.edu"), ("all", "mit.edu"), ("mit", "x.mit.edu")
    ]


def test_top_domains_breaks_ties_by_name(spark):
    df = hosts(spark, "1.b.edu", "1.a.edu", "1.c.edu", "2.c.edu", "1.u.ac.uk")
    assert rows(top_domains(df, k=2)) == [
        ("UK", 1, "u.ac.uk", 1), ("US", 1, "c.edu", 2), ("US", 2, "a.edu", 1)
    ]


def test_activity_skips_lines_without_time(spark):
    df = spark.createDataFrame(
        [("1.a.edu", "02", "05"), ("1.a.edu", "02", "05"), ("2.a.edu", "03", "00"),
         ("3.a.edu", "", None), ("3.a.edu", "99999999", "01"), ("1.b.edu", "09", "01")],
        "host STRING, day STRING, hour STRING",
    )
    grid = top_domain_activity(df)
    assert grid.count() == 2 * 24
    assert rows(grid.where("count > 0")) == [
        ("US", "a.edu", 2, 5, 2), ("US", "a.edu", 3, 0, 1)
    ]
