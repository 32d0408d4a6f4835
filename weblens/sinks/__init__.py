from weblens.sinks.files import export_csv, read_exported_csv, write_text

__all__ = ["export_csv", "read_exported_csv", "write_text"]
