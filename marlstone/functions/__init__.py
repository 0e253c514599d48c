"""Column functions: outputs, texts, arrays, identities. All stay in the JVM."""
