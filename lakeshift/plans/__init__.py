"""End-to-end flows (the only place, with ``lakeshift.sinks``, that acts)."""
