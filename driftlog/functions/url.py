"""URL text functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from driftlog.schemas import ARGS_PREFIX


def strip_prefix(args: Column) -> Column:
    """Remove every occurrence of the ``params=`` prefix, before decoding."""
    return F.replace(args, F.lit(ARGS_PREFIX), F.lit(""))


def url_decode(text: Column, strict: bool = False) -> Column:
    """UTF-8 percent-decoding; ``+`` becomes a space.

    A bad escape such as ``%zz`` gives null, or raises when ``strict``.
    """
    return F.url_decode(text) if strict else F.try_url_decode(text)


def decode_args(args: Column, strict: bool = False) -> Column:
    return url_decode(strip_prefix(args), strict)


def query_string(url: Column) -> Column:
    """The query part of a URL (without ``?`` or fragment); null when absent."""
    return F.try_parse_url(url, F.lit("QUERY"))
