"""Column expressions. All stay in the JVM but those in ``unicode`` and the speaker scrubber in ``grounding``."""
