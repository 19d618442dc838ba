"""Value ranges of the visitor histograms."""

from __future__ import annotations

# Report column -> least value that falls into it; a range ends where the next starts.
PAGE_VIEWS = {
    "pv0_uv": 0,
    "pv1_uv": 1,
    "pv2_5_uv": 2,
    "pv6_10_uv": 6,
    "pv11_20_uv": 11,
    "pv21_30_uv": 21,
    "pv31_40_uv": 31,
    "pv41_50_uv": 41,
    "pv51_100_uv": 51,
    "pv101_uv": 101,
}
VISITS = {
    "v1_uv": 1,
    "v2_uv": 2,
    "v3_uv": 3,
    "v4_uv": 4,
    "v5_uv": 5,
    "v6_uv": 6,
    "v7_uv": 7,
    "v8_uv": 8,
    "v9_uv": 9,
    "v10_uv": 10,
    "v11_15_uv": 11,
    "v16_50_uv": 16,
    "v51_100_uv": 51,
    "v101_200_uv": 101,
    "v201_300_uv": 201,
    "vt301_uv": 301,
}
VISIT_SECONDS = {
    "vt0_10_uv": 0,
    "vt10_30_uv": 10,
    "vt30_60_uv": 30,
    "vt60_120_uv": 60,
    "vt120_180_uv": 120,
    "vt180_240_uv": 180,
    "vt240_300_uv": 240,
    "vt300_600_uv": 300,
    "vt600_1800_uv": 600,
    "vt1800_3600_uv": 1800,
    "vt3600_uv": 3600,
}


def bucket_of(value: str, buckets: dict[str, int]) -> str:
    """SQL for the name of the range that holds `value`."""
    highest_first = sorted(buckets.items(), key=lambda item: item[1], reverse=True)
    return "CASE " + " ".join(f"WHEN {value} >= {least} THEN '{name}'" for name, least in highest_first) + " END"
