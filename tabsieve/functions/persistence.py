"""Parameters shared by the package's estimators."""

from __future__ import annotations

from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable


class JsonState(Params, DefaultParamsReadable, DefaultParamsWritable):
    """Holds everything learned or configured in one JSON-able param, so ``save``/``load`` work."""

    state = Param(Params._dummy(), "state", "configuration and learned values", TypeConverters.identity)

    def get_state(self) -> dict:
        return self.getOrDefault(self.state)
