"""mailsift: alert-digest dataflow as composable Spark DataFrame operators.

Messages go in, dated item digests come out:

    messages -> latest N -> headers -> sender/day filter -> bodies -> html
    html -> anchors -> items -> ordered dedupe -> tail drop -> saved items
    saved items -> keyword any-match -> numbered -> prompt / report

Every operator is ``DataFrame -> DataFrame`` (or ``Column -> Column``) and
carries its order as explicit columns, so nothing depends on row order.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Python tasks (mapInPandas / pandas UDF) carry this package's code with them:
# functions and classes defined here are pickled by value, so executors need
# no installed copy and no path setup (same effect as shipping --py-files).
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from mailsift.session import checkpoint_dir, get_spark  # noqa: E402

__all__ = ["get_spark", "checkpoint_dir"]
