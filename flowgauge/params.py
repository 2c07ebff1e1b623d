"""Settings of the batch and stream jobs."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# --- Fixed values: they must equal the published data set and its settings ---

NULL_LABEL = "NULL"

BENIGN = "Benign"

CLASS_LIMITS = {"Benign": 50000, "DoS_Hulk": 50000, "Port_Scan": 50000}

KEPT_LABELS = (
    "Benign", "DoS_Hulk", "Port_Scan", "DDoS_LOIT",
    "FTP-Patator", "DoS_GoldenEye", "DoS_Slowhttptest",
    "SSH-Patator", "Botnet_ARES", "DoS_Slowloris",
)

TEXT_TO_DOUBLE = (
    "src_port", "dst_port", "duration", "packets_count",
    "fwd_packets_count", "bwd_packets_count", "total_payload_bytes",
    "fwd_total_payload_bytes", "bwd_total_payload_bytes",
    "payload_bytes_max", "payload_bytes_mean", "payload_bytes_std",
)

DROPPED_COLUMNS = (
    "flow_id", "timestamp", "src_ip", "dst_ip",
    "total_header_bytes", "max_header_bytes", "min_header_bytes", "mean_header_bytes", "std_header_bytes",
    "fwd_total_header_bytes", "fwd_max_header_bytes", "fwd_min_header_bytes", "fwd_mean_header_bytes", "fwd_std_header_bytes",
    "bwd_total_header_bytes", "bwd_max_header_bytes", "bwd_min_header_bytes", "bwd_mean_header_bytes", "bwd_std_header_bytes",
    "avg_fwd_bytes_per_bulk", "avg_fwd_packets_per_bulk", "avg_fwd_bulk_rate",
    "avg_bwd_bytes_per_bulk", "avg_bwd_packets_bulk_rate", "avg_bwd_bulk_rate",
    "fwd_bulk_state_count", "fwd_bulk_total_size", "fwd_bulk_per_packet", "fwd_bulk_duration",
    "bwd_bulk_state_count", "bwd_bulk_total_size", "bwd_bulk_per_packet", "bwd_bulk_duration",
    "ece_flag_counts", "cwr_flag_counts", "fwd_ece_flag_counts", "fwd_cwr_flag_counts",
    "bwd_fin_flag_counts", "bwd_psh_flag_counts", "bwd_urg_flag_counts", "bwd_ece_flag_counts",
    "bwd_syn_flag_counts", "bwd_ack_flag_counts", "bwd_cwr_flag_counts", "bwd_rst_flag_counts",
    "active_min", "active_max", "active_mean", "active_std",
    "idle_min", "idle_max", "idle_mean", "idle_std",
    "subflow_fwd_packets", "subflow_bwd_packets", "subflow_fwd_bytes", "subflow_bwd_bytes",
    "payload_bytes_min", "payload_bytes_variance",
    "fwd_payload_bytes_max", "fwd_payload_bytes_min", "fwd_payload_bytes_variance",
    "bwd_payload_bytes_max", "bwd_payload_bytes_min", "bwd_payload_bytes_variance",
    "packet_IAT_total", "fwd_packets_IAT_max", "fwd_packets_IAT_min", "fwd_packets_IAT_total",
    "bwd_packets_IAT_max", "bwd_packets_IAT_min", "bwd_packets_IAT_total",
    "fwd_fin_flag_counts", "fwd_psh_flag_counts", "fwd_urg_flag_counts",
)

# Lower bounds, in order, of the five bands of each report; the last band is the rest.
VOLUME_BANDS = (("critical", 0.6), ("high", 0.35), ("medium", 0.15), ("low", 0.05))
VOLUME_REST = "minimal"
SCORE_BANDS = (("excellent", 99.0), ("good", 97.0), ("fair", 95.0), ("weak", 93.0))
SCORE_REST = "critical"
QUALITY_BANDS = (("green", 99.0), ("blue", 98.0), ("orange", 97.0))
QUALITY_REST = "red"

# Settings of the published run: grid, folds, ensemble, seed, thresholds.
GRID_NUM_TREES, GRID_MAX_DEPTH, N_FOLDS = (30, 50, 75, 100), (5, 8, 10, 11), 5
NUM_TREES, MAX_DEPTH, N_MODELS, SEED, TEST_SHARE = 100, 11, 10, 42, 0.2
TARGET_SCORE, AXIS_MARGIN, RADAR_FLOOR, RADAR_MARGIN = 98.0, 3.0, 70.0, 5.0
DEFAULT_VOLUME, MIN_POINT, POINT_RANGE, TOP_FEATURES, CELL_WIDTH = 1000, 10.0, 50.0, 12, 30

# --- End of fixed values ---

# Tasks of a fit; a forest depends on it and on nothing else of the cluster.
LAYOUT = 32


@dataclass(frozen=True)
class SampleParams:
    """Class caps, the test share and the seed of every hash draw."""

    class_limits: Mapping[str, int] = field(default_factory=lambda: dict(CLASS_LIMITS))
    seed: int = SEED
    test_share: float = TEST_SHARE
    keep_labels: tuple[str, ...] | None = None


@dataclass(frozen=True)
class CleanParams:
    """What the cleaning chain drops and casts."""

    drop_columns: tuple[str, ...] = DROPPED_COLUMNS
    cast_columns: tuple[str, ...] = TEXT_TO_DOUBLE
    text_protocol: str = "protocol"


@dataclass(frozen=True)
class TrainParams:
    """Forest grid, folds, best settings and ensemble size."""

    grid_num_trees: tuple[int, ...] = GRID_NUM_TREES
    grid_max_depth: tuple[int, ...] = GRID_MAX_DEPTH
    n_folds: int = N_FOLDS
    num_trees: int = NUM_TREES
    max_depth: int = MAX_DEPTH
    n_models: int = N_MODELS
    seed: int = SEED
    layout: int = LAYOUT
    parallelism: int = 2


@dataclass(frozen=True)
class ReportParams:
    """Thresholds of the report tables, in percent unless a share."""

    benign: str = BENIGN
    target_score: float = TARGET_SCORE
    axis_margin: float = AXIS_MARGIN
    radar_floor: float = RADAR_FLOOR
    radar_margin: float = RADAR_MARGIN
    default_volume: int = DEFAULT_VOLUME
    min_point: float = MIN_POINT
    point_range: float = POINT_RANGE
    top_features: int = TOP_FEATURES
    cell_width: int = CELL_WIDTH
