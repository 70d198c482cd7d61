"""Trade analytics on Spark: raw trades to candles to the tables an analyst reads.

Layers, from the outside in:

* ``sources`` and ``sinks`` are the only modules that read or write;
* ``plans`` compose whole data products (bronze, silver, candles, marts, loads);
* ``streaming`` drains the same plans incrementally with Structured Streaming;
* ``operators`` are reusable ``DataFrame -> DataFrame`` steps;
* ``functions`` are ``Column -> Column`` expressions.
"""
