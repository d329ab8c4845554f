"""Settings of a run: defaults, ranges, and files of them. YAML where a reader for it is installed, JSON always."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, fields
from pathlib import Path

try:
    import yaml
except ImportError:
    yaml = None


@dataclass
class DataConfig:
    input: str = ""
    output: str = ""
    dialect: str = "master"
    factor: int = 10
    share: float = 0.1
    sample: int | None = None
    review: float = 0.0
    seed: str = "convmill"

    def problems(self) -> list[str]:
        out = []
        if not self.input or not self.output:
            out.append("input and output are needed")
        if self.input and self.input == self.output:
            out.append("input and output differ")
        if self.dialect not in ("master", "proactive", "publication"):
            out.append(f"unknown dialect {self.dialect}")
        if self.factor < 1:
            out.append("factor is 1 or more")
        out += [f"{n} lies between 0 and 1" for n in ("share", "review") if not 0 <= getattr(self, n) <= 1]
        if self.sample is not None and self.sample < 0:
            out.append("sample is 0 or more")
        return out


@dataclass
class TokenConfig:
    most: int = 2048
    percent: int = 50
    batch: int = 8
    template: str = "Assistant: "

    def problems(self) -> list[str]:
        out = [f"{n} is 1 or more" for n in ("most", "batch") if getattr(self, n) < 1]
        return out + (["percent lies between 0 and 100"] if not 0 <= self.percent <= 100 else []) + ([] if self.template else ["the template is empty"])


@dataclass
class Config:
    data: DataConfig = field(default_factory=DataConfig)
    tokens: TokenConfig = field(default_factory=TokenConfig)

    def checked(self) -> Config:
        wrong = self.data.problems() + self.tokens.problems()
        if wrong:
            raise ValueError("; ".join(wrong))
        return self


def _section(kind: type, values: dict):
    names = {f.name for f in fields(kind)}
    unknown = set(values) - names
    if unknown:
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    return kind(**values)


def load(path: str) -> Config:
    """Settings from a file; relative paths in it are relative to its folder."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith(".json"):
        values = json.loads(text)
    elif yaml is None:
        raise ValueError("no YAML reader is installed; use JSON")
    else:
        values = yaml.safe_load(text) or {}
    config = Config(_section(DataConfig, values.get("data", {})), _section(TokenConfig, values.get("tokens", {})))
    base = Path(path).resolve().parent
    for name in ("input", "output"):
        value = getattr(config.data, name)
        if value and "://" not in value and not Path(value).is_absolute():
            setattr(config.data, name, str(base / value))
    return config


def check_paths(spark, config: Config) -> Config:
    """Fails before any work where the input isn't there, is no file or folder of files, or where the output's place is a file. Any store that Spark reads will do."""
    fs_package, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for part in config.data.input.split(","):
        path = fs_package.Path(part)
        found += path.getFileSystem(conf).globStatus(path) or []
    if not found:
        raise ValueError(f"no such input: {config.data.input}")
    out = fs_package.Path(config.data.output)
    fs = out.getFileSystem(conf)
    if fs.exists(out) and fs.getFileStatus(out).isFile():
        raise ValueError(f"the output is a file: {config.data.output}")
    return config


def save(config: Config, path: str) -> None:
    values = asdict(config)
    text = json.dumps(values, indent=2) if path.endswith(".json") or yaml is None else yaml.safe_dump(values, sort_keys=False)
    Path(path).write_text(text, encoding="utf-8")
