"""lmplake: an interval electricity-price lake on Spark.

Main entry points:

* ``lmplake.session.build_session`` - session defaults (``cluster=True`` for large clusters);
* ``lmplake.plans.cycle.run_fetch_cycle`` - one fetch cycle: pages -> typed -> intake + serving -> next requests;
* ``lmplake.streaming.streams.start_control_stream`` - the fetch/merge loop driven by queue messages;
* ``lmplake.streaming.streams.start_day_merge`` / ``lmplake.sinks.lake.sweep_intake`` - keep day tables current;
* ``lmplake.sources.feed_source.read_feed`` / ``read_feed_stream`` - paged feeds as a Spark data source;
* ``lmplake.operators`` - the DataFrame operators (normalise, merge, pulls, serving, quality).
"""

__version__ = "0.1.0"
