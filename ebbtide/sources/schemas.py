"""Declared schemas of the raw tables; files are read with them, never with inference."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, N = T.StringType(), T.DateType(), T.DoubleType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


CUSTOMER_INFO = _struct(
    unique_customer_identifier=S, datevalue=D, contract_status=S, contract_dd_cancels=N, dd_cancel_60_day=N, ooc_days=N,
    technology=S, speed=N, line_speed=N, sales_channel=S, crm_package_name=S, tenure_days=N,
)
CEASE = _struct(unique_customer_identifier=S, cease_placed_date=D, cease_completed_date=S, reason_description=S, reason_description_insight=S)
CALLS = _struct(unique_customer_identifier=S, event_date=D, call_type=S, talk_time_seconds=N, hold_time_seconds=N)
USAGE = _struct(unique_customer_identifier=S, calendar_date=D, usage_download_mbs=S, usage_upload_mbs=S)
RAW = {"customer_info": CUSTOMER_INFO, "cease": CEASE, "calls": CALLS, "usage": USAGE}
