"""Signatures made with OpenSSL by the sample key (RSA-2048, PSS, MGF1, SHA-256)
over the canonical manifest of the image below in 500-character chunks.
"""

import base64

FIRMWARE_VERSION = "v2.4.1"
DEVICE_MODEL = "demo-device"
PAYLOAD = "abc" * 400

# Salt of 222 bytes, the longest.
VALID = base64.b64decode(
    "rn5is0deNR+DJ1eKq/BWR9GyT8enRB49JSZebB/DQxScPKyOTTk9M7mSsA0x+KXsyk+vOaUYZPcbFGmUoPyoE4IS"
    "Eq7pLlrdurR9tXMYH63iaMbPbL6otnlkCvtgna/b5mgxJu8Q4S9VmTcLFXBaBUUy1/7BOixeNkQ5ara01DaP/82z"
    "5n0i5t1QLZdcosJ0Kgz3/eBGerGCJ5HcpM2PftqHHzKh68WyHbQfCnLhTFfzfDYsvuEdAFs854decEvVSuntka9r"
    "P7bf898BHU3KN/iHL6NDlgtr2IEdbKYP+Xka0it0l5rOoGDIxptXPI7xTiV1Q+910Aj4Ng+By0kxMA=="
)

# Salt of 32 bytes.
SHORT_SALT = base64.b64decode(
    "q5e2S//Z79y1gqhv88s2UTJX8eAzW9XhquLBTAb8lHoh+VD92a0Yh5PIkFb5qHThnVMMhdoZMkknQlutoUvhiDbs"
    "JFvJbk4RuGTAay7VCxS9FO3ZoE92RDPJcvFlAuIRN5B8GN4izkME61BK0TbgjeljmJHu5rPQnLuKG5vvivyX1EKI"
    "vLB2nnfhkedvI0MYpuEWy118WNjWG1x9Dn2z5lNMYSLCyNUZtgQQ5qeE8t8kGQGNc3Vttwz94njlHWc7ea8JVNAj"
    "PERf/JceMpRQPZEpYE8ZLSklQj+GkW74j4qXQGz9jVCckrCTLyaaBMXcLHmJjfRodi8ePVi8lGoNJw=="
)
