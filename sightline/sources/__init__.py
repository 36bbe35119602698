from sightline.sources.tables import table

__all__ = ["table"]
