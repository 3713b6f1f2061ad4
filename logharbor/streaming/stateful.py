"""Sample suppression with Spark's own keyed state."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from logharbor.operators.dedup import INPUTS, ChangeFold


def dedup_with_state(
    samples: DataFrame,
    key_cols: Sequence[str] = ("session_id", "device_id"),
    order_cols: Sequence[str] = ("ts_ms", "row_no"),
) -> DataFrame:
    """Keep the samples of a stream that changed since the device's last kept one.

    The state is one sample per device. A device's samples of one trigger are sorted in
    one task, so the trigger's input must be limited; ``rounds.dedup_rounds`` has no such
    need.
    """
    filled = samples.withColumns(
        {c: F.coalesce(c, F.lit(0)).cast(samples.schema[c].dataType) for c in INPUTS}
    )
    fold, order, names = ChangeFold(), list(order_cols), samples.columns
    state_type = T.StructType([T.StructField(c, T.LongType()) for c in INPUTS])

    def keep(key: tuple, pieces: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(pieces)).sort_values(order, kind="stable")
        columns = [rows[c].to_numpy(dtype=np.int64) for c in INPUTS]
        before = list(state.get) if state.exists else None
        marked, after = fold.run(columns, before)
        state.update(tuple(after))
        yield rows.loc[marked, names]

    return filled.groupBy(*key_cols).applyInPandasWithState(
        keep, samples.schema, state_type, "append", GroupStateTimeout.NoTimeout
    )
