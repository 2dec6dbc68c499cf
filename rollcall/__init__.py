"""rollcall: roster synchronisation as set-based Spark jobs.

Every job takes DataFrames and returns DataFrames (reports or change sets).
Applying a change set to a live system is left to the caller.

Layout
------
sources/    readers and writers (feed JSON, mapping CSV, LMS snapshots, state)
functions/  column expressions (e-mail key, names, timestamps, messages)
operators/  relational building blocks (shape, feed filters, identity,
            enrollment, letters, set differences, mappings, ordered scans)
plans/      the data jobs a user calls (sync, course report, group
            reconciliation, renames, course plans, access grants, reports)
streaming/  incremental sync over landed feed files (Structured Streaming)
"""

from rollcall.session import get_session, checkpoint_dir, materialize  # noqa: F401

__version__ = "0.1.0"
