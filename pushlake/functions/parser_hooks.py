"""Example of a user parser as a Python table function (P12): a class whose ``eval``
yields 0..n rows for one input. It reads push messages as P2 and P3 do, for users whose
parser is Python code; the built-in parsers stay on the JVM. Every item gives one row:
its fields, or the reason for which it was rejected."""

from __future__ import annotations

import json

from pushlake.operators.parse import SENTINEL_MSG_ID, TARGET_STEPS

ENVELOPE_SCHEMA = "appkey string, platform string, msg_id long, uid long, itime long, reject_reason string"
_JAVA_SPACE = "".join(map(chr, range(0x21)))


def as_long(value) -> int | None:
    """A JSON number or number text within 64 bits; anything else is None."""
    if isinstance(value, str):
        try:
            value = int(value.strip())
        except ValueError:
            return None
    if not isinstance(value, int) or isinstance(value, bool) or not -(1 << 63) <= value < 1 << 63:
        return None
    return value


def as_text(value) -> str:
    """A JSON value as Spark prints it."""
    if isinstance(value, str):
        return value
    return json.dumps(value, separators=(",", ":"), ensure_ascii=False)


class EnvelopeParser:
    def eval(self, body: str):
        try:
            message = json.loads(body)
        except (TypeError, ValueError):
            yield self.rejected("json")
            return
        rows = message.get("rows") if isinstance(message, dict) else None
        if rows is None:
            rows = [message]
        if not isinstance(rows, list):
            yield self.rejected("rows")
            return
        for item in rows:
            yield self.item(item)

    @staticmethod
    def rejected(reason: str):
        return (None, None, None, None, None, reason)

    def item(self, item):
        if not isinstance(item, dict):
            return self.rejected("object")
        msg_id, itime, uid = (as_long(item.get(k)) for k in ("msg_id", "itime", "uid"))
        if msg_id is None:
            return self.rejected("msg_id")
        if msg_id == SENTINEL_MSG_ID:
            return self.rejected("sentinel")
        step = item.get("step")
        if step is None or as_text(step).strip(_JAVA_SPACE) not in TARGET_STEPS:
            return self.rejected("step" if step is None else "step_not_target")
        if item.get("appkey", "") is None:
            return self.rejected("appkey_null")
        if itime is None or uid is None:
            return self.rejected("itime" if itime is None else "uid")
        appkey = as_text(item["appkey"]).strip(_JAVA_SPACE) if "appkey" in item else "null"
        platform = item.get("platform")
        return (appkey, "null" if platform is None else as_text(platform), msg_id, uid, itime, None)
