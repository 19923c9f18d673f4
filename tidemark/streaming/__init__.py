from tidemark.streaming.landing import follow_landing, parent_folder

__all__ = ["follow_landing", "parent_folder"]
