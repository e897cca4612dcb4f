"""DataFrame -> DataFrame operators over ordered change logs."""
