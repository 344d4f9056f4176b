"""Declarative description of a table to clean and model, and of a forest configuration."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

DEFAULT_SENTINELS: tuple[str, ...] = ("-", "nan", "null")


@dataclass(frozen=True)
class TableSpec:
    """Names the roles of the columns of one table.

    label         class column (string or numeric)
    key           unique row id used for the reproducible split and for ordered samples
    categoricals  string feature columns (lower-cased, null -> ``unknown``, indexed + one-hot)
    numerics      numeric feature columns; empty means "every column not named elsewhere"
    drop          columns removed before modelling
    schema        optional declared types, applied with ``try_cast``
    non_negative  columns whose negative values are clamped to 0
    sentinels     texts that mean "missing"
    """

    label: str
    key: str | None = None
    categoricals: tuple[str, ...] = ()
    numerics: tuple[str, ...] = ()
    drop: tuple[str, ...] = ()
    schema: T.StructType | None = None
    non_negative: tuple[str, ...] = ()
    sentinels: tuple[str, ...] = DEFAULT_SENTINELS
    split_ratio: float = 0.8
    seed: int = 42

    def feature_columns(self, columns: list[str]) -> list[str]:
        if self.numerics:
            return list(self.numerics)
        skip = {self.label, self.key, *self.categoricals, *self.drop}
        return [c for c in columns if c not in skip]


@dataclass(frozen=True)
class ForestConfig:
    """One model configuration of the three-way comparison."""

    name: str
    scale: bool = False
    pca_k: int | None = None
    num_trees: int = 35
    max_depth: int = 10
    seed: int = 42
    max_bins: int = 32
    extra: dict = field(default_factory=dict)


def default_configs(num_trees: int = 35, max_depth: int = 10, seed: int = 42, pca_k: int = 10) -> list[ForestConfig]:
    """Raw forest, standardised forest, standardised + PCA forest."""
    common = dict(num_trees=num_trees, max_depth=max_depth, seed=seed)
    return [
        ForestConfig("without_normalization", **common),
        ForestConfig("with_normalization", scale=True, **common),
        ForestConfig("with_normalization_pca", scale=True, pca_k=pca_k, **common),
    ]


# --- fixed values: the network-flow record layout the reference declares -------------------------
# Column order, label and type sets must equal the reference's for its files to load; listed as text.
FLOW_COLUMNS: tuple[str, ...] = (
    "id_orig_p", "id_resp_p", "proto", "service", "flow_duration", "fwd_pkts_tot",
    "bwd_pkts_tot", "fwd_data_pkts_tot", "bwd_data_pkts_tot", "fwd_pkts_per_sec",
    "bwd_pkts_per_sec", "flow_pkts_per_sec", "down_up_ratio", "fwd_header_size_tot",
    "fwd_header_size_min", "fwd_header_size_max", "bwd_header_size_tot",
    "bwd_header_size_min", "bwd_header_size_max", "flow_FIN_flag_count",
    "flow_SYN_flag_count", "flow_RST_flag_count", "fwd_PSH_flag_count",
    "bwd_PSH_flag_count", "flow_ACK_flag_count", "fwd_URG_flag_count",
    "bwd_URG_flag_count", "flow_CWR_flag_count", "flow_ECE_flag_count",
    "fwd_pkts_payload_min", "fwd_pkts_payload_max", "fwd_pkts_payload_tot",
    "fwd_pkts_payload_avg", "fwd_pkts_payload_std", "bwd_pkts_payload_min",
    "bwd_pkts_payload_max", "bwd_pkts_payload_tot", "bwd_pkts_payload_avg",
    "bwd_pkts_payload_std", "flow_pkts_payload_min", "flow_pkts_payload_max",
    "flow_pkts_payload_tot", "flow_pkts_payload_avg", "flow_pkts_payload_std",
    "fwd_iat_min", "fwd_iat_max", "fwd_iat_tot", "fwd_iat_avg", "fwd_iat_std",
    "bwd_iat_min", "bwd_iat_max", "bwd_iat_tot", "bwd_iat_avg", "bwd_iat_std",
    "flow_iat_min", "flow_iat_max", "flow_iat_tot", "flow_iat_avg", "flow_iat_std",
    "payload_bytes_per_second", "fwd_subflow_pkts", "bwd_subflow_pkts",
    "fwd_subflow_bytes", "bwd_subflow_bytes", "fwd_bulk_bytes", "bwd_bulk_bytes",
    "fwd_bulk_packets", "bwd_bulk_packets", "fwd_bulk_rate", "bwd_bulk_rate",
    "active_min", "active_max", "active_tot", "active_avg", "active_std",
    "idle_min", "idle_max", "idle_tot", "idle_avg", "idle_std",
    "fwd_init_window_size", "bwd_init_window_size", "fwd_last_window_size",
    "Attack_type",
)
FLOW_STRING_COLUMNS: frozenset[str] = frozenset({"proto", "service", "Attack_type"})
FLOW_INT_COLUMNS: frozenset[str] = frozenset({
    "id_orig_p", "id_resp_p", "fwd_pkts_tot", "bwd_pkts_tot", "fwd_data_pkts_tot",
    "bwd_data_pkts_tot", "fwd_header_size_tot", "fwd_header_size_min",
    "fwd_header_size_max", "bwd_header_size_tot", "bwd_header_size_min",
    "bwd_header_size_max", "flow_FIN_flag_count", "flow_SYN_flag_count",
    "flow_RST_flag_count", "fwd_PSH_flag_count", "bwd_PSH_flag_count",
    "flow_ACK_flag_count", "fwd_URG_flag_count", "bwd_URG_flag_count",
    "flow_CWR_flag_count", "flow_ECE_flag_count", "fwd_init_window_size",
    "bwd_init_window_size", "fwd_last_window_size",
})
FLOW_NON_NEGATIVE: tuple[str, ...] = (
    "flow_duration", "fwd_pkts_tot", "bwd_pkts_tot", "fwd_data_pkts_tot", "bwd_data_pkts_tot",
)
# --- end of fixed values --------------------------------------------------------------------------


def flow_schema() -> T.StructType:
    """Declared types of the flow records: 3 strings, 25 ints, the rest doubles, all nullable."""

    def kind(name: str) -> T.DataType:
        if name in FLOW_STRING_COLUMNS:
            return T.StringType()
        if name in FLOW_INT_COLUMNS:
            return T.IntegerType()
        return T.DoubleType()

    return T.StructType([T.StructField(n, kind(n), True) for n in FLOW_COLUMNS])


def flow_spec() -> TableSpec:
    """Spec of the reference's data set: label ``Attack_type``; ``proto``/``service`` categorical."""
    return TableSpec(
        label="Attack_type",
        categoricals=("proto", "service"),
        schema=flow_schema(),
        non_negative=FLOW_NON_NEGATIVE,
    )
