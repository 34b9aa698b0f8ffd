from quarry.sources.corpus import COMMIT_COL, check_ids, ingest

__all__ = ["COMMIT_COL", "ingest", "check_ids"]
