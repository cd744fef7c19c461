import os

os.environ.setdefault("PYTHONHASHSEED", "0")
