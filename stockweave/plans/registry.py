"""Model registry: which model needs which, and how a layer is built."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.session import at_once, materialize
from stockweave.sources.tables import TABLES

# Build order of the layers; reports come last because they read facts.
LAYERS = ("staging", "intermediate", "dim", "fact", "daily_reports", "features")

Ref = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Sliced:
    """A model as sums that may be taken over slices of its rows by ``key`` and then be added up.

    ``sums`` gives them for the frames of ``refs``, those with the key cut down to a
    slice; ``total`` makes the model of the sums of all slices.
    """

    key: str
    sums: Callable[..., DataFrame]
    total: Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Model:
    name: str
    layer: str
    build: Callable[..., DataFrame]
    refs: tuple[str, ...]
    sliced: Sliced | None = None


MODELS: dict[str, Model] = {}


def model(layer: str, *refs: str, sliced: Sliced | None = None):
    """Register ``fn(*frames)``; its arguments are the models or tables in ``refs``."""

    def register(fn):
        MODELS[fn.__name__] = Model(fn.__name__, layer, fn, refs, sliced)
        return fn

    return register


class Models:
    """Resolves names to frames: landing tables from ``source``, models by building.

    ``stored`` may give the written version of a model; where it returns None
    the model is planned inline, so Catalyst prunes and pushes through it. With more
    than one of ``slices`` a model that can be is built slice by slice, each of them
    written: what one shuffles may go before the next.
    """

    def __init__(
        self,
        spark: SparkSession,
        source: Callable[[str], DataFrame],
        stored: Callable[[str], DataFrame | None] = lambda name: None,
        slices: int = 1,
    ):
        self.spark = spark
        self._source = source
        self._stored = stored
        self._slices = slices
        self._frames: dict[str, DataFrame] = {}

    def ref(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._resolve(name)
        return self._frames[name]

    def _resolve(self, name: str) -> DataFrame:
        if name in MODELS:
            stored = self._stored(name)
            return self.build(name) if stored is None else stored
        if name in TABLES:
            return self._source(name)
        raise KeyError(f"no model or table named {name}")

    def keep(self, name: str) -> DataFrame:
        """Write a model once for all that read it from here on in this plan."""
        self._frames[name] = materialize(self.ref(name))
        return self._frames[name]

    def build(self, name: str) -> DataFrame:
        declared = MODELS[name]
        frames = [self.ref(r) for r in declared.refs]
        if declared.sliced is None or self._slices == 1:
            return declared.build(*frames)
        key, parts = declared.sliced.key, []
        for k in range(self._slices):
            own = F.pmod(F.xxhash64(key), F.lit(self._slices)) == k
            cut = [df.where(own) if key in df.columns else df for df in frames]
            parts.append(materialize(declared.sliced.sums(*cut)))
        return declared.sliced.total(reduce(DataFrame.unionByName, parts))


def layer_order(layer: str) -> list[str]:
    """Models of a layer, each after those it reads from the same layer."""
    done: list[str] = []

    def visit(name: str):
        if name in done or name not in MODELS or MODELS[name].layer != layer:
            return
        for r in MODELS[name].refs:
            visit(r)
        done.append(name)

    for name in MODELS:
        visit(name)
    return done


def run_layer(
    models: Models,
    layer: str,
    write: Callable[[str, DataFrame], None],
    only: Iterable[str] = (),
    also_after: Callable[[str], Iterable[str]] = lambda name: (),
) -> list[str]:
    """Build and write every model of a layer; returns the names written.

    Models that read none of each other are written side by side; a model waits for
    those of the layer it reads and for ``also_after`` of its name, if they come
    before it in ``layer_order``.
    """
    wanted = set(only)
    left = [name for name in layer_order(layer) if not wanted or name in wanted]
    names = list(left)
    while left:
        ready: list[str] = []
        for k, name in enumerate(left):
            if not {*MODELS[name].refs, *also_after(name)} & set(left[:k]):
                ready.append(name)
        at_once(lambda name: write(name, models.build(name)), ready)
        left = [name for name in left if name not in ready]
    return names
