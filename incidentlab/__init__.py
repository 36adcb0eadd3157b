"""incidentlab: incident-record analytics expressed as Spark DataFrame plans.

Every public operator is a function ``DataFrame -> DataFrame`` (column names are
parameters), so the same code serves the monthly incident feeds and any table
with the same shape.
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle this package's functions by value, so the Python code of the
    grouped maps and UDFs travels with each task and executors need not have
    the package installed (nor the driver's working directory)."""
    import sys
    import warnings

    from pyspark import cloudpickle

    if not hasattr(cloudpickle, "register_pickle_by_value"):
        warnings.warn("this PySpark cannot ship the package with its tasks; pass it with --py-files", stacklevel=2)
        return
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()
