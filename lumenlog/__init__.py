"""lumenlog — incident-log analytics expressed as Spark DataFrame operators.

Every operator is a ``DataFrame -> DataFrame`` function that works the same
on batch and streaming input; nothing is collected to the driver.
"""

__version__ = "0.1.0"
