"""Settings that suit a machine: a decision table on columns, and the same for one profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GIB = 1 << 30
# Fixed values: (least and most effective batch, steps between evaluations, rank, alpha, length, epochs, checkpointing).
PRESETS = {
    "fast": (16, 32, 200, 16, 32, 2048, 1, False),
    "quality": (8, 16, 100, 64, 64, 4096, 2, True),
    "balanced": (8, 16, 150, 32, 32, 4096, 1, True),
    "low_memory": (4, 8, 150, 16, 32, 2048, 1, True),
}
FIELDS = ("batch_least", "batch_most", "eval_steps", "lora_r", "lora_alpha", "max_length", "epochs", "checkpointing")


def _of(preset: Column, field: str) -> Column:
    out = F
    for name, values in PRESETS.items():
        out = out.when(preset == name, F.lit(values[FIELDS.index(field)]))
    return out.otherwise(F.lit(None))


def recommended(profiles: DataFrame) -> DataFrame:
    """``profiles`` (vram_bytes, system_ram_bytes, gpu_count, os_name, preset) plus tier, batch, accumulation, workers and the preset's settings; null for an unknown preset."""
    preset, vram, ram = F.col("preset"), F.col("vram_bytes"), F.col("system_ram_bytes")
    tier = F.when(vram < 8 * GIB, "low").when(vram < 12 * GIB, "medium").otherwise("high")
    low = preset == "low_memory"
    most = F.when(tier == "low", F.when(low, 2).otherwise(4)).when(tier == "medium", 4).otherwise(F.when(preset == "fast", 8).otherwise(4))
    batch = F.least(most, _of(preset, "batch_most"))
    at_once = batch * F.greatest(F.col("gpu_count"), F.lit(1))
    accumulation = F.greatest(F.lit(1), F.ceil(_of(preset, "batch_least") / at_once)).cast("int")
    workers = F.when(F.col("os_name") == "Windows", F.when(low, 0).otherwise(2)).when(ram < 16 * GIB, 0).when(ram < 32 * GIB, 2).otherwise(F.when(low, 2).otherwise(4))
    known = preset.isin(*PRESETS)
    return profiles.withColumns({"tier": tier, "batch": F.when(known, batch), "accumulation": F.when(known, accumulation), "workers": F.when(known, workers), "save_steps": 2 * _of(preset, "eval_steps"), **{f: _of(preset, f) for f in FIELDS[2:]}})


def merged(base: dict, overrides: dict) -> dict:
    """``base`` with the sections of ``overrides`` laid over its own; neither is changed."""
    out = {k: dict(v) if isinstance(v, dict) else v for k, v in base.items()}
    for section, values in overrides.items():
        out[section] = {**out.get(section, {}), **values} if isinstance(values, dict) and isinstance(out.get(section, {}), dict) else values
    return out
