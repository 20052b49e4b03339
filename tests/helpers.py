"""Builders for hand-made records (all values invented)."""

import json
from urllib.parse import quote_plus

from pyspark.sql import Row

from driftlog import schemas as S

PAYLOAD = {
    "b": "shop", "s": "h5", "en": "fav", "et": "click", "cu": "https://a.example.com/x",
    "pu": "https://a.example.com/", "uid": "u1", "sid": "s1", "ref": "", "land": "",
    "d": {"gs": "g1", "oid": "o1", "st": "1", "lvst": "", "chl": "c1", "poid": "p1",
          "catId": "cat1", "shopId": "shop1", "ob": "x", "sq": "1", "lvo": "0", "pr": "9.9",
          "pt": "1", "so": "s", "amt": "2", "sum": "3"},
}


def line(args=None, ts="2020-07-18T09:58:30+08:00", **extra):
    out = {"timestamp": ts, "client_ip": "192.0.2.7", "method": "GET", "status": "200",
           "domain": "t.example.com", "http_referer": "", "request_id": "r1",
           "agent": "Mozilla/5.0", "uri": "/t.gif"}
    if args is not None:
        out["args"] = args
    out.update(extra)
    return out


def args_of(payload) -> str:
    return "params=" + quote_plus(json.dumps(payload, separators=(",", ":")))


def envelope(line_obj, as_text=True) -> str:
    return json.dumps({"@timestamp": "2020-07-18T01:58:30.000Z",
                       "@metadata": {"beat": "filebeat", "type": "_doc", "version": "7.8.0",
                                     "topic": "t"},
                       "message": json.dumps(line_obj) if as_text else line_obj,
                       "input": {"type": "log"}})


def record(value, offset=0, partition=0, topic="t", key=None):
    return Row(topic=topic, partition=partition, offset=offset, timestamp=None, key=key,
               value=value)


def records_df(spark, values, topic="t"):
    rows = [record(v, offset=i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, S.RECORD)
