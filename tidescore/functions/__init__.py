from tidescore.functions import codec, features, maths, text, vectors

__all__ = ["codec", "features", "maths", "text", "vectors"]
