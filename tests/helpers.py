import json

from pyspark.sql import functions as F

from telemill.sources.messages import accepted, decode

DAY = 86400000


def text(spark, *messages):
    rows = [(m if isinstance(m, str) else json.dumps(m),) for m in messages]
    return spark.createDataFrame(rows, "value string")


def message(values, portnum=None, app="app1", id="d1", dts=1000, pts=1200, **more):
    return {"app": app, "id": id, "portnum": len(values) if portnum is None else portnum,
            "dtimestamp": dts, "ptimestamp": pts, "values": values, **more}


def messages(spark, *rows):
    return accepted(decode(text(spark, *rows)))


def rules(spark, *rows):
    """Rows of (id, did, pidx, cmd, avg, used)."""
    return spark.createDataFrame(
        rows, "id bigint, did string, pidx int, cmd string, avg string, used int"
    ).withColumn("app", F.lit("app1"))


RULE_TABLE = [
    (1, "d1", 0, "ADD:10", "MIN", 1),
    (2, "d1", -1, "SUB:100", "MIN&HOUR", 1),
    (3, "d1", 2, "FOO:1", None, 1),
    (4, "d2", -5, "DIV:100", "60000", 1),
    (5, "d2", 1, "RVS", None, 1),
    (6, "d3", 0, "EXPR1:(X+1)*2-X/4", "HOUR&bogus&300000", 1),
    (7, "d3", 1, "EXPR1:2X", "MIN", 1),
    (8, "d3", 2, "ADD", None, 1),
    (9, "d4", 0, "NEG", "MIN", 0),
    (10, "d1", 0, "MUL:3", None, 1),
]
