"""ledgerline: record reconciliation, statistics reports and data control on Spark.

Entry points:

* ``ledgerline.operators.checks`` - the two daily reconciliations (``first_level_unmatched``,
  ``key_level_unmatched``) and their building blocks in ``operators.recon`` / ``operators.caps``;
* ``ledgerline.operators.pivot`` - ``stat_pivot``, ``ordered_extract``;
* ``ledgerline.operators.control`` - completeness and freshness reports on tables and files;
* ``ledgerline.operators.joblog`` - finished / running job reports;
* ``ledgerline.sources.sinks`` - partition-overwrite tables and dated CSV exports;
* ``ledgerline.plans.daily.run_day`` - one day's work end to end; ``python -m ledgerline`` for
  the same from the command line.

Every function takes and returns DataFrames built from native Spark expressions; the reference
day is always an argument.
"""

__version__ = "0.1.0"
