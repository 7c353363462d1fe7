"""quire: bibliography, load-log and range-copy analytics as Spark DataFrame jobs.

Modules are grouped the way a Spark job is: ``sources`` (scans and fixture
adapters), ``functions`` (column expressions), ``operators`` (reusable
DataFrame compositions such as ordinals and relational division), ``plans``
(the user-level queries), ``streaming`` (the command service) and ``sinks``.
"""

from quire.session import build_session, ensure_checkpoint_dir, scratch_path

__all__ = ["build_session", "ensure_checkpoint_dir", "scratch_path"]
