from tramline.functions import codes, numeric, text, time

__all__ = ["codes", "numeric", "text", "time"]
