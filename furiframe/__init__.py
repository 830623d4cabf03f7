"""furiframe: annotated-text OCR corpus preparation and scoring on Spark.

Everything is expressed as DataFrame -> DataFrame operators
(``furiframe.operators``) built from Column -> Column helpers
(``furiframe.functions``). Sources and sinks live in ``furiframe.sources``,
the stateless streaming variant in ``furiframe.streaming`` and the
registered queries over the driver tables in ``furiframe.plans``.
"""

__version__ = "0.1.0"

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions of this package travel to the executors by value: nothing needs installing there.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
