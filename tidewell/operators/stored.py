"""Forecast models that say what they are: parameters as rows, everything else as metadata, through the ML writer and reader."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml import Model
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.networks import FeedForward, Network, RegimeNetwork
from tidewell.operators import forecast, training

KINDS = ("var", "varnn", "varnn_frozen", "srvar")
ROWS = "name string, i int, j int, value double"


class ForecastModel(Model, MLWritable, MLReadable):
    """A fitted network with what is needed to score with it: lags, differences, series in order, bounds of the scaler.

    ``transform`` makes the one-shot forecast after the last day of a dense wide table with the columns ``date`` and the series.
    """

    def __init__(self, kind: str = "var", fitted: training.Fit | None = None, p: int = 1, order: int = 1, features: Sequence[str] = (), scaler: Mapping[str, tuple[float, float]] | None = None, day: str = "date"):
        super().__init__()
        if kind not in KINDS:
            raise ValueError(f"unknown kind {kind}")
        self.kind, self.fitted, self.p, self.order, self.features, self.day = kind, fitted, p, order, list(features), day
        self.scaler = {name: (float(low), float(high)) for name, (low, high) in (scaler or {}).items()}

    def _bounds(self) -> Column | None:
        if not self.scaler:
            return None
        sides = lambda c: F.struct(*[F.lit(v).alias(n) for n, v in zip(("low", "high"), self.scaler[c])])
        return F.struct(*[sides(c).alias(c) for c in self.features])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Missing first differences count as zero, so a table of p days is enough."""
        return forecast.next_step(dataset, self.day, self.features, self.fitted, self.p, self._bounds(), True, self.order)

    def describe(self) -> dict:
        network = self.fitted.network
        told = {"kind": self.kind, "name": self.fitted.name, "p": self.p, "order": self.order, "features": self.features, "scaler": self.scaler, "day": self.day}
        if isinstance(network, RegimeNetwork):
            told |= {"states": network.shapes["states"][0], "hidden": network.hidden, "tau": network.tau}
        if isinstance(network, FeedForward) and network.output is not None:
            told["output"] = [np.asarray(part).tolist() for part in network.output]
        return told

    @staticmethod
    def network_of(told: Mapping) -> Network:
        """The network that metadata describe, without parameters."""
        p, k = told["p"], len(told["features"])
        if told["kind"] == "srvar":
            return RegimeNetwork(k, told["states"], told["hidden"], told["tau"])
        if told["kind"] == "var":
            return forecast.LinearModel(p, k)
        output = told.get("output")
        return FeedForward(p, k, tuple(np.array(part) for part in output) if output else None)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: ForecastModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata={"model": self.model.describe()})
        rows = training.params_frame(self.sparkSession, self.model.fitted, "", None)
        rows.select("name", "i", "j", "value").coalesce(1).write.parquet(f"{path}/params")


class _Reader(MLReader):
    def load(self, path: str) -> ForecastModel:
        told = DefaultParamsReader.loadMetadata(path, self.sparkSession)["model"]
        network = ForecastModel.network_of(told)
        rows = self.sparkSession.read.schema(ROWS).parquet(f"{path}/params").toPandas()
        fitted = training.Fit(told["name"], network, network.flatten(training.arrays_of(rows, network)))
        scaler = {name: tuple(bounds) for name, bounds in told["scaler"].items()}
        return ForecastModel(told["kind"], fitted, told["p"], told["order"], told["features"], scaler, told["day"])
