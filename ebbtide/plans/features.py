"""Feature matrix: as-of panel, activity, label and encoding put together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.config import DEFAULTS, Settings
from ebbtide.functions.scalars import ID
from ebbtide.operators import activity, contract, encoding, labels, panel as panels
from ebbtide.operators.activity import SNAP
from ebbtide.session import settle


def labelled_accounts(panel: DataFrame, cease: DataFrame, snapshots: str | Sequence[str], settings: Settings = DEFAULTS) -> DataFrame:
    """Account features and label of every as-of panel row; the event logs are not touched."""
    base = contract.contract_features(panels.latest_asof(panel, snapshots), keep=[SNAP])
    gone = labels.leavers(cease, snapshots, settings.label).withColumn("churned", F.lit(1))
    return base.join(gone, [ID, SNAP], "left").withColumn("churned", F.coalesce("churned", F.lit(0)))


def assemble(panel: DataFrame, calls: DataFrame, usage: DataFrame, cease: DataFrame, snapshots: str | Sequence[str], settings: Settings = DEFAULTS) -> DataFrame:
    """Features and label for every as-of panel row, before encoding.

    All sides are keyed by (customer, snapshot) and already reduced to that
    grain, so each join moves at most one row per customer from the logs.
    """
    out = labelled_accounts(panel, cease, snapshots, settings)
    for part in (activity.call_features(calls, snapshots, settings.call_windows), activity.usage_features(usage, snapshots)):
        out = out.join(part, [ID, SNAP], "left")
    return out


def feature_matrix(
    panel: DataFrame,
    calls: DataFrame,
    usage: DataFrame,
    cease: DataFrame,
    snapshots: str | Sequence[str],
    encoder: encoding.FittedEncoder | None = None,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Model-ready matrix. Without an encoder the encoded columns are leave-fold-out values,
    whose counts need only the accounts and the label, not the logs.
    """
    df = assemble(panel, calls, usage, cease, snapshots, settings)
    if encoder:
        return encoder.apply(df)
    return encoding.out_of_fold(df, settings.encoding, counts_from=labelled_accounts(panel, cease, snapshots, settings))


def materialise(
    panel: DataFrame,
    calls: DataFrame,
    usage: DataFrame,
    cease: DataFrame,
    snapshots: Sequence[str],
    folder: str,
    settings: Settings = DEFAULTS,
) -> encoding.FittedEncoder:
    """Write one matrix per snapshot and return the encoder.

    Features and labels of all dates are put together in one pass over the panel and the
    logs and settled. The encoder is fitted on the earliest snapshot, which gets
    leave-fold-out values; later snapshots get its full-data map. It is stored next to
    the matrices.
    """
    from ebbtide.sources.sinks import write_features

    spark = panel.sparkSession
    first, *later = sorted(snapshots)
    rows = settle(assemble(panel, calls, usage, cease, [first, *later], settings))
    earliest = F.col(SNAP) == F.lit(first).cast("date")
    encoding.fit(rows.where(earliest), settings.encoding).save(f"{folder}/encoder")
    encoder = encoding.FittedEncoder.load(spark, f"{folder}/encoder")
    write_features(encoding.out_of_fold(rows.where(earliest), settings.encoding), f"{folder}/matrix")
    if later:
        write_features(encoder.apply(rows.where(~earliest)), f"{folder}/matrix")
    return encoder
