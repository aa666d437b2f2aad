"""barforge: trade-stream analytics on Spark.

Raw trade messages -> admission/quarantine -> VARIANT raw layer (bronze) ->
typed keep-latest trades (silver) -> exact one-minute bars (gold), plus the
checks that watch them.  Layers:

* ``functions``  scalar Catalyst helpers (JSON paths, casts, time, exact decimals)
* ``operators``  DataFrame -> DataFrame operators (admission, silver, gold, checks)
* ``sources``    topic source, raw-layer sink and scans, derived test inputs
* ``streaming``  incremental maintenance, watermark bars, lifecycle, layout
* ``plans``      the registered plans and their SQL oracle
"""
