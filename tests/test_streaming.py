from millrace.operators import filter_suffix, log_time_parts, parse_access_log, with_region
from tests.helpers import rows
from tests.test_weblog import GOLDEN


def test_log_operators_take_a_stream(spark, tmp_path):
    """Parsing, time parts and region assignment give a stream the same rows as a batch."""
    extra = 'p1.ucl.ac.uk - - [02/Jul/1995:10:20:30 -0400] "GET / HTTP/1.0" 200 -'
    (tmp_path / "log.txt").write_text("\n".join([line for line, _ in GOLDEN] + [extra]))

    def plan(lines):
        return with_region(filter_suffix(log_time_parts(parse_access_log(lines)), "host", ".ac.uk"))

    query = (
        plan(spark.readStream.text(str(tmp_path)))
        .writeStream.format("memory").queryName("parsed_log").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    streamed = rows(spark.table("parsed_log"))
    assert streamed == rows(plan(spark.read.text(str(tmp_path / "log.txt"))))
    assert len(streamed) == 1 and streamed[0][-2:] == ("UK", "ucl.ac.uk")
