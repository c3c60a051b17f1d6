"""The batch logic over files as they arrive."""
