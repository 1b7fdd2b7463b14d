"""Sources: lines with byte offsets, whole JSON files, SQL dumps and archives."""
