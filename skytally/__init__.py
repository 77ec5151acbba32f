"""skytally: flight on-time rankings on Spark DataFrames, batch and streaming.

Entry points:

* ``skytally.plans.queries``: the batch queries, each a function of a DataFrame
  with one ``line`` column (airport popularity, carriers by on-time arrivals,
  grouped top-10s, itineraries);
* ``skytally.streaming.runner``: the same questions as Structured Streaming
  jobs writing keyed result tables (``skytally.streaming.changelog.read_latest``);
* ``skytally.sources``: text/Kafka line sources and the line writer;
* ``python -m skytally``: one job per process from the command line.
"""

__version__ = "0.1.0"
