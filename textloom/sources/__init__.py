"""What is read and written: files, logs, index tables."""
